"""Source divergence audit over the vocabulary of a minimal acyclic transducer.

Terms that enough documents of a language hold are kept.  The sorted kept terms of a language make a minimal
acyclic transducer over UTF-8 bytes: states with the same continuations are one state, and each
arc carries the number of kept terms that sort before the ones behind it, so that the sum along a term's path is the
term's ordinal.  UTF-8 order is byte order, so ordinals sort as terms do.  The texts are streamed
through the transducer: all terms of a stretch of text take a byte's step together, those that leave the
automaton drop out, and those that end in a final state are counted under their ordinals.  From there on,
counts, probabilities, divergences and ties are numbers; terms return for the report alone.

Kept terms are cut into shards of at most ``SHARD_TERMS`` neighbours, one transducer each,
so a transducer has a bounded size however large a vocabulary grows.  A pass over the texts
takes transducers of at most ``PASS_BYTES`` along; a vocabulary that needs more takes more passes.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bizlens.llm.common import materialize, ship_package, table, text_or_empty

MIN_DOCS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
SHARD_TERMS = 1 << 17
SHARD_BYTES = 8 << 20  # of terms in a shard, or one term
PASS_BYTES = 64 << 20
WINDOW = 1 << 20  # bytes of text that take their steps together, or one term
PIECE = 1 << 20  # characters of text whose terms are listed together
HELD = 1 << 20  # entries that a task holds before it sends them on
BLOCK_TERMS = 4096
TILE_SOURCES = 128
#: Bytes of a term: ASCII letters and all bytes of other characters.
TERM_BYTES = np.array([chr(b).isalpha() or b >= 0x80 for b in range(128)] + [True] * 128)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
_terms = re.compile(rb"[A-Za-z\x80-\xff]+").findall


def distinct_terms(text: bytes) -> set[bytes]:
    """The terms of one text, A-Z lower-cased; long texts in stretches that end between terms."""
    found: set[bytes] = set()
    start = 0
    while start < len(text):
        stop = start + PIECE
        if stop < len(text):
            cut = re.compile(rb"[^A-Za-z\x80-\xff]").search(text, stop)
            stop = cut.start() if cut else len(text)
        found.update(_terms(text[start:stop].lower()))
        start = stop
    return found


def _document_counts(batches):
    """(lang, term, docs): partial numbers of documents."""
    import pyarrow as pa

    held: dict[str, dict[bytes, int]] = {}
    size = 0

    def out():
        for lang, counts in held.items():
            terms = list(counts)
            for at in range(0, len(terms), 1 << 16):
                some = terms[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.binary()).cast(pa.string()),
                                                  pa.array([counts[t] for t in some], pa.int64())], ["lang", "term", "docs"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = held.setdefault(lang, {})
            size -= len(counts)
            for term in distinct_terms(text.as_py().encode()):
                counts[term] = counts.get(term, 0) + 1
            size += len(counts)
            if size >= HELD:
                yield from out()
                size = 0
    yield from out()


class Transducer:
    """Minimal acyclic transducer of sorted distinct terms, with their ordinals."""

    def __init__(self, terms: list[bytes]):
        # a state under construction: its arcs (byte, state) and whether a term ends there
        register: dict[tuple, int] = {}
        behind: list[int] = []  # terms behind a settled state
        arcs: list[tuple] = []
        finals: list[bool] = []
        path: list[list] = [[[], False]]
        before = b""

        def settle(depth: int) -> None:
            while len(path) > depth + 1:
                own, final = path.pop()
                key = (final, *own)
                state = register.get(key)
                if state is None:
                    state = register[key] = len(arcs)
                    arcs.append(tuple(own))
                    finals.append(final)
                    behind.append(final + sum(behind[to] for _, to in own))
                parent = path[-1][0]
                parent[-1] = (parent[-1][0], state)

        for term in terms:
            shared = 0
            for shared, (x, y) in enumerate(zip(term, before)):
                if x != y:
                    break
            else:
                shared = min(len(term), len(before))
            settle(shared)
            for byte in term[shared:]:
                path[-1][0].append((byte, -1))
                path.append([[], False])
            path[-1][1] = True
            before = term
        path.insert(0, [[(0, -1)], False])
        settle(0)
        self.start = path[0][0][0][1] if terms else 0
        # arcs as a table: key = state * 256 + byte, in order, with next state and output
        keys, nexts, outputs = [], [], []
        for state, own in enumerate(arcs):
            passed = int(finals[state])
            for byte, to in own:
                keys.append(state << 8 | byte)
                nexts.append(to)
                outputs.append(passed)
                passed += behind[to]
        self.longest = max(map(len, terms), default=0)
        self._set(np.array(keys, "<i8"), np.array(nexts, "<i4"), np.array(outputs, "<i4"), np.array(finals, "?"))

    def _set(self, keys, nexts, outputs, finals) -> None:
        self.keys, self.nexts, self.outputs, self.finals = keys, nexts, outputs, finals
        self.rows = None

    def to_bytes(self) -> bytes:
        head = np.array([self.start, self.longest, len(self.keys), len(self.finals)], "<i8")
        return b"".join(x.tobytes() for x in (head, self.keys, self.nexts, self.outputs, self.finals))

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        self = cls.__new__(cls)
        self.start, self.longest, n, states = np.frombuffer(data, "<i8", 4).tolist()
        self._set(np.frombuffer(data, "<i8", n, 32), np.frombuffer(data, "<i4", n, 32 + 8 * n), np.frombuffer(data, "<i4", n, 32 + 12 * n),
                  np.frombuffer(data, "?", states, 32 + 16 * n))
        return self

    def _table(self) -> None:
        """A row of arcs for each state and a column for each byte that any arc has, column 0 for all others: the
        place of the next state's row and the output in one number.  A last state, without a way out,
        takes whatever has no arc.  The table's size is bounded by the shard's."""
        used = np.unique(self.keys & 255)
        self.column = np.zeros(256, np.uint8)
        self.column[used] = np.arange(1, len(used) + 1)  # term bytes are fewer than 255
        self.width = len(used) + 1
        self.rows = np.full((len(self.finals) + 1) * self.width, len(self.finals) * self.width << 32, np.int64)
        self.rows[(self.keys >> 8) * self.width + self.column[self.keys & 255]] = (self.nexts.astype(np.int64) * self.width) << 32 | self.outputs

    def ordinals(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinal of each term ``data[begin:end]`` (bytes, lower-cased), -1 for terms not in the list."""
        out = np.full(len(begins), -1, np.int64)
        if not len(self.keys) or not len(begins):
            return out
        if self.rows is None:
            self._table()
        length = np.minimum(ends - begins, self.longest + 1)
        order = np.argsort(-length, kind="stable")  # terms that have come to their end stand behind
        over = len(order) - np.cumsum(np.bincount(length, minlength=self.longest + 2))  # how many are longer
        columns, begins = self.column[data], begins[order]
        states, sums = np.full(len(order), self.start * self.width, np.int64), np.zeros(len(order), np.int64)
        for step in range(self.longest):
            n = int(over[step])
            if not n:
                break
            arc = self.rows[states[:n] + columns[begins[:n] + step]]
            states[:n] = arc >> 32
            sums[:n] += arc & 0xFFFFFFFF
        known = np.append(self.finals, False)[states // self.width] & (length[order] <= self.longest)
        out[order[known]] = sums[known]
        return out


@lru_cache(maxsize=64)
def transducer_of(data: bytes) -> Transducer:
    """A transducer, with its table, once for a Python worker."""
    return Transducer.from_bytes(data)


def _shards(most: int):
    """Of runs of sorted (lang, term) rows: a row with the run's transducer, and a row for each term with its place."""
    def run(batches):
        import pyarrow as pa

        now, held, size = None, [], 0

        def out():
            low, n = held[0].decode(), len(held)
            row = lambda langs, *columns: pa.RecordBatch.from_arrays(
                [pa.array([now] * langs, pa.string()), pa.array([low] * langs, pa.string()),
                 *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.string())))], ["lang", "low", "n", "transducer", "at", "term"])
            yield row(1, [n], [Transducer(held).to_bytes()], [None], [None])
            for at in range(0, n, 1 << 14):
                some = held[at:at + (1 << 14)]
                yield row(len(some), [None] * len(some), [None] * len(some), range(at, at + len(some)), [t.decode() for t in some])

        for batch in batches:
            for lang, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (lang != now or len(held) >= most or size >= SHARD_BYTES):
                    yield from out()
                    held, size = [], 0
                now, term = lang, term.encode()
                held.append(term)
                size += len(term)
        if held:
            yield from out()

    return run


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term) of the terms in at least ``min_docs`` documents of their language."""
    counts = docs.select("lang", "text").mapInArrow(_document_counts, "lang string, term string, docs long")
    return counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term")


def vocabulary(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> tuple[DataFrame, DataFrame]:
    """The shards (lang, base, n, transducer), ``base`` the ordinal of a shard's first term, and the
    terms with their ordinals (lang, ordinal, term)."""
    ordered = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    both = materialize(ordered.mapInArrow(_shards(shard_terms), "lang string, low string, n long, transducer binary, at long, term string"), "vocabulary")
    shards = both.where("n IS NOT NULL")
    before = Window.partitionBy("lang").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(shards.select("lang", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")  # a row a shard
    terms = both.where("term IS NOT NULL").join(bases, ["lang", "low"]).select("lang", (F.col("base") + F.col("at")).alias("ordinal"), "term")
    return shards.join(bases, ["lang", "low"]).select("lang", "base", "n", "transducer"), terms


def _recount(shards: list[tuple[str, int, bytes]]):
    """(lang, source, ordinal, n): partial counts of the shards' terms in the texts."""
    def run(batches):
        import pyarrow as pa

        by_lang: dict[str, list] = {}
        for lang, base, data in shards:
            by_lang.setdefault(lang, []).append((base, transducer_of(data)))
        groups: dict[tuple[str, str], int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            keys, n = (np.concatenate(x) for x in zip(*held))
            keys, at = np.unique(keys, return_inverse=True)
            return keys, np.bincount(at, n, len(keys)).astype(np.int64)

        def out():
            keys, n = merged()
            names = list(groups)
            which = (keys >> 40).tolist()
            return pa.RecordBatch.from_arrays([pa.array([names[g][0] for g in which], pa.string()), pa.array([names[g][1] for g in which], pa.string()),
                                               pa.array(keys & ((1 << 40) - 1)), pa.array(n)], ["lang", "source", "ordinal", "n"])

        for batch in batches:
            if not len(batch):
                continue
            texts = batch.column(2)
            offsets = np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, 4 * texts.offset).astype(np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            group = np.array([groups.setdefault(x, len(groups)) for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.int64)
            for lang in set(batch.column(0).to_pylist()) & set(by_lang):
                own = np.array([x == lang for x in batch.column(0).to_pylist()])
                for first, last in stretches(own):  # neighbours are read together
                    for bytes_, begins, ends, doc in terms_of(data, offsets[first:last + 1]):
                        for base, transducer in by_lang[lang]:
                            ordinal = transducer.ordinals(bytes_, begins, ends)
                            hit = ordinal >= 0
                            keys, n = np.unique(group[first + doc[hit]] << 40 | (ordinal[hit] + base), return_counts=True)
                            held.append((keys, n))
                            size += len(keys)
                        if size >= HELD:
                            held = [merged()]
                            size = len(held[0][0])
                            if size >= HELD // 2:
                                yield out()
                                held, size = [], 0
        if held:
            yield out()

    return run


def stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last (exclusive) of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def terms_of(data: np.ndarray, offsets: np.ndarray):
    """Windows of some neighbouring texts: lower-cased bytes, begins and ends of terms, numbers of their texts."""
    start, stop = int(offsets[0]), int(offsets[-1])
    inside = offsets[1:-1]
    while start < stop:
        end = min(start + WINDOW, stop)
        following = int(np.searchsorted(inside, end))
        limit = int(inside[following]) if following < len(inside) else stop  # where the text at the end of the window ends
        while end < limit and TERM_BYTES[data[end]]:  # perhaps within a term: on to its end
            more = TERM_BYTES[data[end:min(end + 4096, limit)]]
            gap = int(more.argmin())
            end += len(more) if more[gap] else gap
        bytes_ = LOWER[data[start:end]]
        is_term = TERM_BYTES[bytes_]
        first, last = is_term.copy(), is_term.copy()
        first[1:] &= ~is_term[:-1]
        last[:-1] &= ~is_term[1:]
        cuts = inside[(inside > start) & (inside < end)] - start
        first[cuts] |= is_term[cuts]  # a text's end parts terms as well
        last[cuts - 1] |= is_term[cuts - 1]
        begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        upto = np.searchsorted(begins, np.append(offsets[1:] - start, len(bytes_)))
        yield bytes_, begins, ends, np.repeat(np.arange(len(offsets)), np.diff(upto, prepend=0))
        start = end


def recount(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of each kept term in each group of ``docs``."""
    sizes = shards.select("lang", "base", F.octet_length("transducer").alias("size")).orderBy("lang", "base").toLocalIterator()
    passes: list[tuple[int, list]] = []
    for s in sizes:  # a row a shard, without the transducers
        if not passes or passes[-1][0] + s.size > PASS_BYTES:
            passes.append((0, []))
        passes[-1] = (passes[-1][0] + s.size, [*passes[-1][1], (s.lang, s.base)])
    found = None
    for number, (_, wanted) in enumerate(passes):
        langs = sorted({lang for lang, _ in wanted})
        low, high = (F.struct(F.lit(lang).alias("lang"), F.lit(base).cast("long").alias("base")) for lang, base in (wanted[0], wanted[-1]))
        place = F.struct("lang", "base")
        own = shards.where((place >= low) & (place <= high))
        taken = [tuple(r) for r in own.select("lang", "base", "transducer").collect()]  # at most PASS_BYTES
        counts = docs.where(F.col("lang").isin(langs)).select("lang", "source", "text").mapInArrow(_recount(taken), "lang string, source string, ordinal long, n long")
        counts = materialize(counts.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), f"counts-{number}")
        found = counts if found is None else found.unionByName(counts)
    return found if found is not None else docs.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + SMOOTHING) / (total + SMOOTHING * terms)), in whole numbers."""
    wide = lambda c: c.cast("decimal(20,0)")
    return (F.lit(1) + F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * (wide(n) + SMOOTHING), wide(total) + SMOOTHING * wide(terms))).cast("long")


def whole_probabilities(n: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """``probability`` for arrays, by two steps of long division: no product leaves 64 bits."""
    high, low = 31_250, 32_000  # their product is UNIT
    bottom = total + SMOOTHING * terms
    first, rest = np.divmod((n + SMOOTHING) * high, bottom)
    return 1 + first * low + rest * low // bottom


def _differences(key, counts, groups):
    """One block of terms: the sums of differences of all pairs of two tiles of sources."""
    import pyarrow as pa

    terms, size = groups.column("terms")[0].as_py(), groups.column("size")[0].as_py()
    tile, source = groups.column("tile").to_numpy(), groups.column("source").to_pylist()
    total, place = groups.column("total").to_numpy(), {s: i for i, s in enumerate(source)}
    n = np.zeros((len(source), size), np.int64)
    n[np.array([place[s] for s in counts.column("source").to_pylist()], np.int64), counts.column("at").to_numpy().astype(np.int64)] = counts.column("n").to_numpy()
    p = whole_probabilities(n, total[:, None], terms) if size else n
    left, right = np.flatnonzero(tile == key[2].as_py()), np.flatnonzero(tile == key[3].as_py())
    rows = [(source[i], source[j], int(v)) for i in left.tolist() for j, v in zip(right.tolist(), np.abs(p[right] - p[i]).sum(axis=1).tolist()) if i != j]
    if key[2].as_py() != key[3].as_py():
        rows += [(j, i, v) for i, j, v in rows]
    a, b, v = list(zip(*rows)) or [(), (), ()]
    return pa.table({"lang": pa.array([key[0].as_py()] * len(rows), pa.string()), "source": pa.array(a, pa.string()), "item": pa.array(b, pa.string()), "value": pa.array(v, pa.int64())})


def pair_divergences(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of sources of a language.

    ``groups``: lang, source, total, terms.  Terms go by blocks, sources by tiles; a task holds a
    block of terms of two tiles at a time, whatever the numbers of terms and sources.
    """
    order = Window.partitionBy("lang").orderBy("source")
    tiled = groups.withColumn("tile", F.floor((F.row_number().over(order) - 1) / TILE_SOURCES).cast("long"))
    tiled = materialize(tiled.withColumn("tiles", (F.max("tile").over(Window.partitionBy("lang")) + 1)), "tiles")

    def to_pairs(df: DataFrame) -> DataFrame:
        """Each row to all pairs of tiles that its tile is in."""
        other = df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        return other.withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other")).drop("other")

    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK_TERMS))
    size = F.least(F.lit(BLOCK_TERMS), F.col("terms") - F.col("block") * BLOCK_TERMS)
    sides = to_pairs(tiled.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)))).withColumn("size", size)
    held = counts.join(tiled.select("lang", "source", "tile", "tiles"), ["lang", "source"])
    held = to_pairs(held.withColumn("block", F.floor(F.col("ordinal") / BLOCK_TERMS)).withColumn("at", F.col("ordinal") % BLOCK_TERMS))
    keys = ["lang", "block", "a", "b"]
    parts = (held.select(*keys, "source", "at", "n").groupBy(*keys).cogroup(sides.select(*keys, "source", "tile", "total", "terms", "size").groupBy(*keys))
             .applyInArrow(_differences, "lang string, source string, item string, value long"))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, text_col: str = "text", lang_col: str = "lang",
                      source_col: str = "source", shard_terms: int = SHARD_TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): every source of a language against every other
    one (``pair``), and the terms by which it stands out most from its language (``term``).

    Null texts, languages and sources count as empty strings.  Texts without terms make groups all the
    same.  Repeated rows are documents of their own; ids play no part; other columns are
    ignored; a language without kept terms gives its pairs with value 0; an empty table gives no rows.
    Equal values are ranked by the item's UTF-8 order.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"), text_or_empty(text_col).alias("text"))
    kept = materialize(kept_terms(docs, min_docs), "kept")
    shards, ordinals = vocabulary(kept, shard_terms)
    counts = recount(docs, shards)
    sizes = shards.groupBy("lang").agg(F.sum("n").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    groups = materialize(docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
                         .select("lang", "source", zero("total"), zero("terms")), "groups")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_divergences(counts, groups).withColumn("rank", F.row_number().over(by_value)).withColumn("part", F.lit("pair"))

    langs = groups.groupBy("lang").agg(F.sum("total").alias("all_total"))
    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("all_n"))
    p = probability(F.col("n"), F.col("total"), F.col("terms"))
    q = probability(F.col("all_n"), F.col("all_total"), F.col("terms"))
    apart = counts.join(groups, ["lang", "source"]).join(langs, "lang").join(whole, ["lang", "ordinal"]).withColumn("value", p - q).where("value > 0")
    by_ordinal = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = apart.withColumn("rank", F.row_number().over(by_ordinal)).where(F.col("rank") <= top_terms).select("lang", "source", "ordinal", "value", "rank")
    terms = best.join(ordinals, ["lang", "ordinal"]).withColumnRenamed("term", "item").withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    return pairs.select(*columns).unionByName(terms.select(*columns))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of all sources of every language."""
    return source_divergence(table(spark, sf_dir, "documents"))


ORACLE_OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), occurrences AS MATERIALIZED (
  SELECT id, lang, source, unnest(w) AS term FROM docs
), kept AS MATERIALIZED (
  SELECT lang, term FROM occurrences GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), pairs AS (
  SELECT DISTINCT lang, source FROM docs
), vocabulary AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM occurrences JOIN kept USING (lang, term) GROUP BY lang, source, term
), every AS (
  SELECT p.lang, p.source, k.term, coalesce(c.n, 0) AS n FROM pairs AS p JOIN kept AS k ON p.lang = k.lang
  LEFT JOIN counts AS c ON c.lang = p.lang AND c.source = p.source AND c.term = k.term
), scored AS MATERIALIZED (
  SELECT lang, source, term, n,
         CAST(1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS BIGINT) AS p,
         CAST(1 + (1000000000 * CAST(sum(n) OVER (PARTITION BY lang, term) + 5 AS HUGEINT)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS BIGINT) AS q
  FROM every JOIN vocabulary USING (lang)
), divergence AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(CAST(sum(abs(x.p - y.p)) AS BIGINT), 0) AS value
  FROM pairs AS a JOIN pairs AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN scored AS x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN scored AS y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM divergence
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term', term, p - q, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS rank
    FROM scored WHERE n > 0 AND p > q
  ) WHERE rank <= 50
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked
"""
