"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Each kind's pattern is run over the whole text; matches and the gaps between them give spans in
code points.  Candidate values are hashed, and each hash is counted over the distinct
repositories and owners that hold it.  A value that ``EXAMPLE_OWNERS`` owners or more hold in
``EXAMPLE_REPOS`` repositories or more, or that spells out a placeholder, is a widely copied example; another
value that looks random is a live-looking credential of its owners; the rest is weak.

A text's work grows about as its length and its number of matches: positions are running sums in blocks,
and redaction cuts the text once, at byte positions.

Hot values: (value, repository, owner) is reduced by partial aggregates before anything else, so
a credential that stands in a third of all rows costs a few rows a task; the join back of
classes to spans is an equi-join that AQE may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import let, materialize, running, running_sums, table, text_or_empty

#: Kind, pattern, group that holds the value, least length of the value, and a cheap literal
#: without which there is no match.  The first three are the base kinds, in their order.
KINDS = [
    ("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 8, None),
    ("access", r"AKIA[A-Z0-9]+", 0, 16, "AKIA"),
    # runs of 32 or more are the runs of any length less the shorter ones
    ("hex", r"[0-9a-f]{32,}", 0, 32, None),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, "gh"),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, "xox"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 20, "eyJ"),
    # the value is the body: up to the END line, or, where that is missing, the base64 runs that follow
    ("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----([^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+(?=-----END [A-Z0-9 ]*PRIVATE KEY)"
            r"|(?:(?:\s|\\[nr])*+(?:[A-Za-z0-9+/]{16,}+={0,2}|[A-Za-z0-9+/]{1,15}+={1,2}))*+)(?:-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----)?", 1, 0, "PRIVATE KEY"),
]
BASE_KINDS = ["assign", "access", "hex"]
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 3  # a value that many owners hold in one shared repository is in one place, not copied widely
FIXED_KINDS = ["access", "github", "slack", "jwt"]
ASSIGN_LETTERS = 5  # distinct characters of an assigned value that is no repeat
WORDS = r"^[_./=+-]*+(?:(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[a-zA-Z](?![a-zA-Z0-9]))[_./=+-]*+)++$"
LIVE_LENGTH = 16
LIVE_LETTERS = 8  # distinct characters of a value that looks random
PEM_BODY = r"[A-Za-z0-9+/]{16}"  # a header alone holds no key
PLACEHOLDER = r"(?i)example|sample|change_?me|your|dummy|placeholder|redacted|test|x{4,}|0{6,}|12345|abcdef"


def _matches(text: Column, kind: int) -> Column:
    """array<struct<start, end, first, last, kind, name, value>> of one kind; start and end in code
    points, first and last in bytes."""
    name, pattern, group, least, literal = KINDS[kind]
    regex = F.lit(pattern)
    whole, values = F.regexp_extract_all(text, regex, F.lit(0)), F.regexp_extract_all(text, regex, F.lit(group))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), values.alias("value"))
    empty = F.array().cast("array<struct<start:int,end:int,first:int,last:int,kind:int,name:string,value:string>>")

    def spans(found: Column) -> Column:
        ends = running_sums(F.transform(found, lambda m: (F.char_length(m["gap"]) + F.char_length(m["whole"])).cast("long")))
        lasts = running_sums(F.transform(found, lambda m: (F.octet_length(m["gap"]) + F.octet_length(m["whole"])).cast("long")))
        every = F.transform(F.arrays_zip(found.alias("m"), ends.alias("end"), lasts.alias("last")), lambda z: F.struct(
            (z["end"] - F.char_length(z["m"]["whole"])).cast("int").alias("start"), z["end"].cast("int").alias("end"),
            (z["last"] - F.octet_length(z["m"]["whole"])).cast("int").alias("first"), z["last"].cast("int").alias("last"),
            F.lit(kind).alias("kind"), F.lit(name).alias("name"), z["m"]["value"].alias("value")))
        return F.filter(every, lambda s: F.char_length(s["value"]) >= least)

    # the last gap has no match after it
    found = let(F.filter(pairs, lambda m: m["whole"].isNotNull()), spans)
    there = text.rlike(pattern)
    return F.when((text.contains(literal) & there) if literal else there, found).otherwise(empty)


def secret_spans(text: Column) -> Column:
    """All spans of a text by start, then kind as listed."""
    every = F.concat(*(_matches(text, i) for i in range(len(KINDS))))
    keyed = F.transform(every, lambda s: F.struct(s["start"], s["kind"], s["end"], s["name"], s["first"], s["last"], F.sha2(s["value"], 256).alias("hash"),
                                                  _live_looking(s["value"], s["name"]).alias("live_looking"), _placeholder(s["value"], s["name"]).alias("placeholder")))
    return F.array_sort(keyed)


def _placeholder(value: Column, name: Column) -> Column:
    """Spells out a placeholder; key bodies are long enough to hold such letters by chance."""
    return value.rlike(PLACEHOLDER) & ~((name == "pem") & value.rlike(PEM_BODY))


def _live_looking(value: Column, name: Column) -> Column:
    """Kinds of a fixed format are live by it; assigned values unless they are words or repeats."""
    letters = F.size(F.array_distinct(F.split(value, "")))
    mixed = ~value.rlike(WORDS) | value.rlike("[a-z]{24}|[A-Z]{24}")  # no word is that long
    return (F.when(name == "pem", value.rlike(PEM_BODY)).when(name.isin(FIXED_KINDS), True)
            .when(name == "assign", (letters >= ASSIGN_LETTERS) & mixed)
            .otherwise((F.char_length(value) >= LIVE_LENGTH) & (letters >= LIVE_LETTERS) & value.rlike("[0-9]")))


def find_candidates(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column) -> tuple[DataFrame, DataFrame]:
    """The rows with spans (id, repo, owner, spans, a row key) and one narrow row per input row
    (without the key), both written to the shared folder: the texts are read once."""
    found = docs.select(F.col(id_col).alias("id"), repo.cast("string").alias("repo"), owner.cast("string").alias("owner"),
                        secret_spans(text_or_empty(text_col)).alias("spans"), F.xxhash64(text_or_empty(text_col)).alias("text_hash"))
    found = materialize(found, "spans")
    return materialize(found.where(F.size("spans") > 0).withColumn("row", F.monotonically_increasing_id()), "candidates"), found


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, n_repos, n_owners, n_rows, class of every candidate value; null repositories and
    owners count as one of their own."""
    each = candidates.select("repo", "owner", F.explode("spans").alias("s")).select(
        F.coalesce("repo", F.lit("")).alias("repo"), F.coalesce("owner", F.lit("")).alias("owner"), "s.hash", "s.live_looking", "s.placeholder")
    once = each.groupBy("hash", "repo", "owner").agg(F.count("*").alias("n"), F.max("live_looking").alias("live"), F.max("placeholder").alias("placeholder"))
    owners = (once.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"), F.max("live").alias("live"), F.max("placeholder").alias("placeholder"))
              .groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_rows"), F.max("live").alias("live"), F.max("placeholder").alias("placeholder")))
    repos = once.groupBy("hash", "repo").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("*").alias("n_repos"))
    copied = (F.col("n_owners") >= EXAMPLE_OWNERS) & (F.col("n_repos") >= EXAMPLE_REPOS)
    verdict = F.when(copied | F.col("placeholder"), "example").when(F.col("live"), "live").otherwise("weak")
    return owners.join(repos, "hash").select("hash", "n_repos", "n_owners", "n_rows", verdict.alias("class"))


def _joined(spans: str, names: list[str] | None = None) -> Column:
    kept = F.col(spans) if names is None else F.filter(spans, lambda s: s["name"].isin(names))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["name"] == kind)).cast("long")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None,
                 owner: Column | None = None) -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_example, n_weak, live_spans (kind:start:end, as spans), classes (class:repositories:owners of
    each of ``spans``, in their order), max_repos, max_owners (of the row's values), text_hash,
    live_bytes (array of first, last: the live spans in bytes).

    ``repo`` and ``owner`` default to ``source/lang`` and ``source``.  Null and empty texts have no
    spans; null ids stay; repeated rows each get a row and add nothing to the distinct counts;
    other columns are ignored; an empty table gives an empty result.  Equal starts are ordered by
    kind.  Of overlapping kinds each keeps its span.
    """
    repo = F.concat_ws("/", "source", "lang") if repo is None else repo
    owner = F.col("source") if owner is None else owner
    candidates, found = find_candidates(docs, id_col, text_col, repo, owner)
    classes = ownership(candidates).select("hash", "class", "n_repos", "n_owners")
    each = candidates.select("row", F.posexplode("spans").alias("at", "s")).select("row", "at", "s", "s.hash").join(classes, "hash")
    judged = F.array_sort(F.collect_list(F.struct("at", "s", "class", "n_repos", "n_owners")))
    with_spans = candidates.select("row", "id", "spans", "text_hash").join(each.groupBy("row").agg(judged.alias("judged")), "row").drop("row")
    without = found.where(F.size("spans") == 0).select("id", "spans", "text_hash", F.array().cast(with_spans.schema["judged"].dataType).alias("judged"))
    every = with_spans.unionByName(without)
    live = F.filter("judged", lambda j: j["class"] == "live")
    most = lambda c: F.coalesce(F.array_max(F.transform("judged", lambda j: j[c])), F.lit(0)).cast("long")
    count = lambda c: F.size(F.filter("judged", lambda j: j["class"] == c)).cast("long").alias(f"n_{c}")
    classed = [count(c) for c in ("live", "example", "weak")]
    counts = [_count_of(k).alias(f"n_{k}") for k in BASE_KINDS]
    each_class = F.transform("judged", lambda j: F.concat_ws(":", j["class"], j["n_repos"].cast("string"), j["n_owners"].cast("string")))
    return every.withColumn("live", F.transform(live, lambda j: j["s"])).select(
        F.col("id").alias(id_col), *counts, F.sha2(_joined("spans", BASE_KINDS), 256).alias("base_sha256"), _joined("spans").alias("spans"),
        *classed, _joined("live").alias("live_spans"), F.array_join(each_class, ",").alias("classes"), most("n_repos").alias("max_repos"),
        most("n_owners").alias("max_owners"), "text_hash", F.transform("live", lambda s: F.struct(s["first"], s["last"])).alias("live_bytes"))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each of ``spans`` (array of first, last in bytes, by first) replaced by ``mark``;
    spans that overlap one already replaced lengthen it.  Null spans, or none: the text as it is."""
    def cut(data: Column, found: Column, reached: Column) -> Column:
        # between what earlier spans reached and the next span; a span that begins inside an earlier one has no such piece
        each = F.arrays_zip(found.alias("s"), F.concat(F.array(F.lit(0).cast("long")), reached).alias("from"))
        own = F.filter(each, lambda z: z["s"].isNotNull() & (z["s"]["first"] >= z["from"]))
        pieces = F.transform(own, lambda z: F.substring(data, (z["from"] + 1).cast("int"), (z["s"]["first"] - z["from"]).cast("int")))
        rest = let(F.element_at(reached, -1).cast("int"), lambda last: F.substring(data, last + 1, F.octet_length(data)))
        return F.array_join(F.transform(F.concat(pieces, F.array(rest)), lambda x: x.cast("string")), mark)

    whole = let(text.cast("binary"), lambda data: let(spans, lambda found: let(
        running(F.transform(found, lambda s: s["last"].cast("long")), F.greatest, F.lit(0).cast("long")), lambda reached: cut(data, found, reached))))
    return F.when(F.coalesce(F.size(spans), F.lit(0)) <= 0, text).otherwise(whole)


def redact_live(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None,
                owner: Column | None = None, chars_col: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs`` with live-looking credentials replaced in the text, and
    ``chars_col``, where there is one, set to the length of a changed text.  Spans are matched by id
    and text, so repeated ids and null ids are right; null texts stay null, repeated rows are all
    redacted, other columns stay as they are, an empty table stays empty."""
    hits = scan_secrets(docs, id_col, text_col, repo, owner).where(F.size("live_bytes") > 0)
    hits = hits.select(F.col(id_col).alias("__bizlens_id"), F.col("text_hash").alias("__bizlens_hash"), F.col("live_bytes").alias("__bizlens_spans"))
    hits = materialize(hits.dropDuplicates(["__bizlens_id", "__bizlens_hash"]), "live")
    found = docs.join(hits, F.col(id_col).eqNullSafe(F.col("__bizlens_id")) & (F.xxhash64(text_or_empty(text_col)) == F.col("__bizlens_hash")), "left")
    found = found.withColumn(text_col, redact(F.col(text_col), F.col("__bizlens_spans")))
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        found = found.withColumn(chars_col, F.when(F.col("__bizlens_spans").isNotNull(), F.char_length(text_col).cast(kind)).otherwise(F.col(chars_col)))
    return found.select(*docs.columns)


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole document, with the classes of their values."""
    return scan_secrets(table(spark, sf_dir, "documents")).drop("live_bytes")
