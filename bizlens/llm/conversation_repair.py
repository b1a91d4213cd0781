"""Conversation structure repair through a suffix-shared automaton.

Each row of a conversation becomes one letter, its signature: its role's initial and its first
fault.  A conversation is a word of letters.  Words that end alike share the nodes of their common ends:
a node stands for one suffix, holds its first letter and points to the node of the rest, so the
minimal automaton is built from the end.  Costs depend on what follows alone; so each node gets, once for
all conversations, for each state of the grammar ``(s?(ua)+)?`` the cost-to-go and the first edit of
the best audit of its suffix.  The next node and state hold the rest of that audit, so suffixes of
audits are shared as well.  Edits of one node and state that begin alike are the same edit, so among
equal costs the least first letter gives the ASCII-least audit.

On Spark, distinct words are sorted from their ends by range partitions: words that share an end
stand next to each other, and a task keeps one path of nodes and builds a node once for all the words
of its range (the first path of a range is built again).  Conversations are sorted by turn and
streamed, never collected: what a task holds of a conversation is one letter a row.  A
conversation's rows do meet in one task, because its repaired text is one hash.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from bizlens.llm.common import id_type, materialize, ship_package, table

DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3  # costs; keeping costs nothing
#: Pairs of initials that may follow each other.
LEGAL = {"su", "ua", "au"}
#: Next state of the grammar: 0 nothing yet, 1 after s, 2 after u, 3 after a; it may end in 0 and 3.
STEP = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
#: The role that an edit may give in a state.
EXPECTED = ["u", "u", "a", "u"]
ROLES = {"u": "user", "a": "assistant"}
DAMAGE_KINDS = 20
OTHER = "x"  # roles with other initials; upper-case letters are truncated rows
LOST = "-"  # blank and duplicate rows, which have to go


class SuffixAutomaton:
    """The path of nodes of the last word, from its end; a node holds four costs and four edits."""

    def __init__(self):
        # after the end: a state that may not end has to insert
        self.letters, self.costs, self.edits = [""], [(0, 6, 3, 0)], [".II."]
        self.made = 0

    def _node(self, letter: str) -> None:
        after, role = self.costs[-1], letter.lower()
        extra = TRUNCATED if letter.isupper() else 0
        best = []
        for state in range(4):
            found = [(DELETE + after[state], "D")]
            if letter != LOST:
                if role in STEP[state]:
                    found.append((extra + after[STEP[state][role]], "K"))
                if role != EXPECTED[state]:
                    found.append((REROLE + extra + after[STEP[state][EXPECTED[state]]], "R"))
            best.append(min(found))
        for _ in range(3):  # inserts stay at the node; a path of them repeats no state
            best = [min(x, (INSERT + best[STEP[state][EXPECTED[state]]][0], "I")) for state, x in enumerate(best)]
        self.letters.append(letter)
        self.costs.append(tuple(cost for cost, _ in best))
        self.edits.append("".join(edit for _, edit in best))
        self.made += 1

    def word(self, backwards: str) -> tuple[int, str]:
        """Cost and audit of a word, given from its end; words have to come in order."""
        path, shared = self.letters, 0
        while shared < min(len(backwards), len(path) - 1) and path[shared + 1] == backwards[shared]:
            shared += 1
        del self.letters[shared + 1:], self.costs[shared + 1:], self.edits[shared + 1:]
        for letter in backwards[shared:]:
            self._node(letter)
        audit, state, at = [], 0, len(backwards)
        while (edit := self.edits[at][state]) != ".":
            audit.append(edit)
            if edit != "D":
                state = STEP[state][self.letters[at].lower() if edit == "K" else EXPECTED[state]]
            if edit != "I":
                at -= 1
        return self.costs[-1][0], "".join(audit)


def _audits(batches):
    import pyarrow as pa

    automaton = SuffixAutomaton()
    for batch in batches:
        words = batch.column(0).to_pylist()
        found = [automaton.word(w) for w in words]
        yield pa.RecordBatch.from_arrays([pa.array([w[::-1] for w in words], pa.string()), pa.array([c for c, _ in found], pa.int64()),
                                          pa.array([a for _, a in found], pa.string())], ["word", "cost", "audit"])


def audits_of(words: DataFrame) -> DataFrame:
    """(word, cost, audit) of the distinct words of ``words`` (one string column, ``word``)."""
    backwards = words.select(F.reverse("word").alias("backwards")).distinct()
    ordered = backwards.repartitionByRange("backwards").sortWithinPartitions("backwards")
    return ordered.mapInArrow(_audits, "word string, cost long, audit string")


def _prepared(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows by conversation, in order (null turns first; equal turns by role, then text), with their faults."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    text = F.col("text")
    found = rows.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), space(role_col).alias("role"), space(text_col).alias("text")).repartition("id")
    # the partitioning by id serves this window, so rows move once
    earlier = F.row_number().over(Window.partitionBy("id", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    fault = (F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "blank").when(F.col("earlier"), "duplicate")
             .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated"))
    found = found.withColumn("earlier", earlier).withColumn("fault", fault)
    return found.sortWithinPartitions("id", F.col("turn").asc_nulls_first(), "role", "text", "earlier")


NUMBERS = ["n_rows", "gaps", "blank", "duplicate", "truncated", "illegal"]


def _words(id_kind):
    def run(batches):
        """One row for each conversation: its numbers and its word."""
        import pyarrow as pa

        schema = pa.schema([("id", id_kind), *((c, pa.int64()) for c in NUMBERS), ("word", pa.string())])
        now, letters, out = None, [], []

        def close():
            if letters:
                gaps = last - first + 1 - turns if turns else 0
                out.append((now, len(letters), gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, "".join(letters)))

        for batch in batches:
            for key, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if not letters or key != now:
                    close()
                    now, letters, turns, first, last, illegal, before = key, [], 0, None, None, 0, None
                    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
                if turn is not None and (turns == 0 or turn != last):
                    first, last, turns = turn if first is None else first, turn, turns + 1
                illegal += before is not None and before + initial not in LEGAL
                before = initial
                if fault:
                    faults[fault] += 1
                letter = initial if initial in ("s", "u", "a") else OTHER
                letters.append(LOST if fault in ("blank", "duplicate") else letter.upper() if fault else letter)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)

    return run


def conversation_audits(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation of ``rows``: id, n_rows, gaps, blank, duplicate, truncated, illegal, cost,
    audit (initials of the cheapest edits in order).

    Rows are taken by turn, null turns first, equal turns by role and text.  Null roles and texts count
    as one space; a role's initial is its first character, and roles that begin with none of s, u and a (an empty
    one, too) can't be kept.  Null ids are one conversation.  Repeated rows are duplicates; other
    columns are ignored; an empty table gives no rows.
    """
    ship_package(rows.sparkSession)
    kind = id_type(rows, id_col)
    prepared = _prepared(rows, id_col, turn_col, role_col, text_col)
    narrow = prepared.select("id", F.col("turn").cast("long").alias("turn"), F.substring("role", 1, 1).alias("initial"), "fault")
    words = narrow.mapInArrow(_words(to_arrow_type(rows.schema[id_col].dataType)),
                              f"id {kind}, " + ", ".join(f"{c} long" for c in NUMBERS) + ", word string")
    words = materialize(words, "words")
    found = words.join(materialize(audits_of(words.select("word")), "audits"), "word")
    return found.select(F.col("id").alias(id_col), *NUMBERS, "cost", "audit")


def _edit(id_kind):
    def run(batches):
        """The rows that the audit of each conversation leaves; the audit comes first."""
        import pyarrow as pa

        schema = pa.schema([("id", id_kind), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
        now, edits, at, state, place, out = None, "", 0, 0, 0, []

        def put(edit, role, text):
            nonlocal place
            out.append((now, place, edit, role, text))
            place += 1

        def inserts():
            nonlocal at, state
            while at < len(edits) and edits[at] == "I":
                role = EXPECTED[state]
                put("I", ROLES[role], "")
                at, state = at + 1, STEP[state][role]

        def batch_of():
            done = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema.names)
            out.clear()
            return done

        for batch in batches:
            for key, audit, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if audit is not None:
                    inserts()
                    now, edits, at, state, place = key, audit, 0, 0, 0
                    continue
                inserts()
                edit, at = edits[at], at + 1
                if edit != "D":
                    initial = role[:1] if edit == "K" else EXPECTED[state]
                    put(edit, role if edit == "K" else ROLES[initial], text)
                    state = STEP[state][initial]
            if out:
                yield batch_of()
        inserts()
        if out:
            yield batch_of()

    return run


def repaired_turns(rows: DataFrame, audits: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, place, edit, role, text): the rows of every conversation after the edits of ``audits`` (of
    ``conversation_audits`` over the same rows).  A conversation's rows stand in one partition, in order.

    Nulls, ties, repeated rows, further columns and empty tables: as ``conversation_audits`` states.
    """
    ship_package(rows.sparkSession)
    prepared = _prepared(rows, id_col, turn_col, role_col, text_col)
    first = audits.select(F.col(id_col).alias("id"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                          F.lit(None).cast("string").alias("text"), F.lit(False).alias("earlier"), "audit")
    both = first.unionByName(prepared.select("id", F.col("turn").cast("long").alias("turn"), "role", "text", "earlier", F.lit(None).cast("string").alias("audit")))
    ordered = both.repartition("id").sortWithinPartitions("id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "text", "earlier")
    schema = f"id {id_type(rows, id_col)}, place long, edit string, role string, text string"
    edited = ordered.select("id", "audit", "role", "text").mapInArrow(_edit(to_arrow_type(rows.schema[id_col].dataType)), schema)
    return edited.withColumnRenamed("id", id_col)


def _digest(id_kind):
    def run(batches):
        import pyarrow as pa

        now, state = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([now], id_kind), pa.array([state.hexdigest()])], ["id", "sha256"])
        for batch in batches:
            for key, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 0:
                    if state:
                        yield row()
                    now, state = key, hashlib.sha256()
                state.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        if state:
            yield row()

    return run


def turn_digests(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, sha256) of the newline-joined ``role:text`` of ``repaired_turns``, in the same pass."""
    schema = f"`{id_col}` {id_type(turns, id_col)}, sha256 string"
    return turns.select(id_col, "place", "role", "text").mapInArrow(_digest(to_arrow_type(turns.schema[id_col].dataType)), schema)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` after the faults that CRC-32 of ``conv_id:turn`` draws."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    drawn = F.crc32(F.concat_ws(":", part("conv_id"), part("turn"))) % DAMAGE_KINDS
    role, text = part("role"), part("text")
    rows = conversations.select(
        "conv_id", "turn", F.when(drawn == 4, "user").otherwise(role).alias("role"),
        F.when(drawn == 1, "").when(drawn == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), drawn.alias("drawn"))
    rows = rows.where("drawn <> 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("drawn") == 3, 2).otherwise(1))))
    return rows.select("conv_id", "turn", "role", "text")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Numbers, cost, audit and digest of every conversation, those without rows after the damage too."""
    rows = damage(conversations)
    audits = materialize(conversation_audits(rows), "conversation-audits")
    digests = turn_digests(repaired_turns(rows, audits))
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    found = (every.join(audits, every.id.eqNullSafe(audits.conv_id), "left").drop("conv_id"))
    found = found.join(digests, found.id.eqNullSafe(digests.conv_id), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select(F.col("id").alias("conv_id"), *map(zero, [*NUMBERS[1:], "cost"]), F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage, audit and repair of every conversation."""
    return repair_report(table(spark, sf_dir, "conversations"))
