"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio.

Word unigrams and bigrams are hashed into buckets, whose number follows the corpus: a power of two
from ``1 << BUCKET_BITS`` up, with at most ``GRAMS_A_BUCKET`` distinct n-grams a bucket (estimated
by HyperLogLog over all texts), so collisions weigh the same at every size.  One multinomial is counted over every document (raw corpus), one over trusted documents (target).  Raw counts are brought to
the target's total, and both are smoothed by the same ``SMOOTHING`` counts a bucket, so an n-gram
that neither knows says nothing, in small corpora as in large ones.  A document's score is the
mean over its n-grams of log p_target - log p_raw, each without the document's own counts; it is
kept if the score is at least ``THRESHOLD``, the same for every document: no draw, no quantile.

Raw counts cover all documents, target counts all documents with a trusted label.  Their ids grow
with the corpus, so they are joined without a forced broadcast, to the documents' ids alone; a
bit a document goes back to the texts.  The counts grow with the corpus as well
and never meet in one place: documents are packed into chunks, a chunk sends each of its buckets
once to the part that it belongs to, the part adds up and sends the totals back to the chunk.  A
hot n-gram is one entry a chunk, so small input splits are packed together into chunks that are as large as
a task can hold; a bucket's two counts, mostly small, travel as one byte and are compressed.  A chunk and
a part have bounded sizes, their numbers grow with the input.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import id_type, materialize, materialize_by, ship_package, table, text_or_empty

BUCKET_BITS = 17
GRAMS_A_BUCKET = 4
SKETCH_BITS = 12
CHUNK_BYTES = 56 << 20  # of text in a chunk, or one document
MIN_TASKS = 16  # that pack texts, so that small corpora keep the cores busy
PART_GRAMS = 4 << 20  # n-grams in a part, before a chunk's repeats are counted as one
MIN_PARTS = 64
CHUNKS_A_TASK, MAX_FILES = 4, 1 << 16  # places for chunks: so many for each task that packs them
ZSTD = 6
SMALL = 22  # counts below it and their target counts, 253 pairs, take a byte together
SMOOTHING = 1.0
THRESHOLD = -0.25  # nats a n-gram; clean text scores about 0, junk far below
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"
SPACE_CHARS = " \t\n\v\f\r"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def word_ids(text: str) -> tuple[np.ndarray, list[bytes]]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` as numbers by first occurrence, and the distinct words."""
    seen: dict[bytes, int] = {}
    words = text.encode().split()
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    return ids, list(seen)


def repeat_words(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in a window of three found twice or more in the text."""
    if len(ids) <= WINDOW:
        return 0
    pairs = ids[:-2] * distinct + ids[1:-1]
    if distinct >= 1 << 21:  # keep the product below 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, counts = np.unique(pairs * distinct + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[which] > 1)
    covered = np.zeros(len(ids), bool)
    for i in range(WINDOW):
        covered[starts + i] = True
    return int(covered.sum())


def base_measures(text: str, ids: np.ndarray, distinct: int) -> list[int]:
    """The base columns of one text, in the order of ``BASE``."""
    lines = [x for x in text.split("\n") if x.strip(SPACE_CHARS)]
    return [len(ids), len(text) - sum(map(text.count, SPACE_CHARS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(ids, distinct)]


def gram_hashes(ids: np.ndarray, words: list[bytes]) -> np.ndarray:
    """64-bit hashes of the text's word unigrams and bigrams."""
    import xxhash

    if not len(ids):
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))[ids]
    return np.concatenate([h * np.uint64(0xFF51AFD7ED558CCD),
                           h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)])


def buckets(ids: np.ndarray, words: list[bytes], bits: int = BUCKET_BITS) -> np.ndarray:
    """Buckets of the text's word unigrams and bigrams."""
    return gram_hashes(ids, words) >> np.uint64(64 - bits)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """HyperLogLog registers of some hashes."""
    rest = (hashes << np.uint64(SKETCH_BITS)) | np.uint64(1 << (SKETCH_BITS - 1))
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    np.maximum.at(out, (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), (65 - np.frexp(rest.astype(float))[1]).astype(np.uint8))
    return out


def distinct(registers: np.ndarray) -> float:
    """Estimated number of distinct hashes."""
    m = len(registers)
    found = 0.7213 / (1 + 1.079 / m) * m * m / np.sum(0.5 ** registers.astype(float))
    zeros = np.count_nonzero(registers == 0)
    return m * np.log(m / zeros) if found <= 2.5 * m and zeros else float(found)


def bucket_bits(n: float) -> int:
    """Bits of a bucket for ``n`` distinct n-grams."""
    return max(BUCKET_BITS, (-(-int(n) // GRAMS_A_BUCKET) - 1).bit_length())


def runs(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in order, and how often each is there; sorts ``numbers``, where ``np.unique``
    would copy or hash them."""
    numbers.sort()
    at = np.flatnonzero(np.concatenate([np.ones(min(1, len(numbers)), bool), numbers[1:] != numbers[:-1]]))
    return numbers[at], np.diff(at, append=len(numbers))


def to_planes(numbers: np.ndarray) -> bytes:
    """Numbers of 64 bits, all first bytes, all second ones and so on, as many as the largest needs,
    compressed."""
    import pyarrow as pa

    width = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width].tobytes()
    return bytes([width]) + len(numbers).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def from_planes(data: bytes) -> np.ndarray:
    import pyarrow as pa

    width, n = data[0], int.from_bytes(data[1:9], "little")
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :width] = np.frombuffer(pa.decompress(data[9:], width * n, "zstd"), np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def to_pairs(raw: np.ndarray, target: np.ndarray) -> bytes:
    """Pairs of counts, the second at most the first, compressed: a byte a pair, where the first is below
    ``SMALL``; the others are marked there and follow."""
    small = raw < SMALL
    low = np.where(small, raw, 0)
    parts = [to_planes(x) for x in (np.where(small, low * (low + 1) // 2 + target, 255), raw[~small], target[~small])]
    return b"".join([*(len(x).to_bytes(8, "little") for x in parts), *parts])


def from_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([24, *(int.from_bytes(data[i:i + 8], "little") for i in (0, 8, 16))]).tolist()
    codes, *large = (from_planes(data[a:b]).astype(np.int64) for a, b in zip(ends, ends[1:]))
    first, marked = np.repeat(np.arange(SMALL), np.arange(1, SMALL + 1)), codes == 255
    raw = first[np.where(marked, 0, codes)]
    target = codes - raw * (raw + 1) // 2
    raw[marked], target[marked] = large
    return raw, target


def _pack(parts):
    """Chunks of documents with their ids and numbers of n-grams."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def packed(held):
        texts = pa.Table.from_batches(held).combine_chunks()
        grams, registers = np.zeros(len(texts), np.int64), np.zeros(1 << SKETCH_BITS, np.uint8)
        for i, text in enumerate(texts.column(1)):
            found = gram_hashes(*word_ids(text.as_py()))
            grams[i] = len(found)
            registers = np.maximum(registers, sketch(found))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, texts.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=ZSTD))) as out:
            out.write_table(texts)
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65]), one(texts.column(0).combine_chunks()), one(pa.array(grams)),
                                           pa.array([registers.tobytes()], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                          ["chunk", "ids", "grams", "registers", "docs"])

    held, size = [], 0
    for part in parts:
        start = 0
        for i, n in enumerate(pc.binary_length(part.column(1)).to_pylist()):
            size += n
            if size >= CHUNK_BYTES:
                yield packed([*held, part.slice(start, i + 1 - start)])
                held, size, start = [], 0, i + 1
        if start < len(part):
            held.append(part.slice(start))
    if held:
        yield packed(held)


def _registers(batches):
    import pyarrow as pa

    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for batch in batches:
        for registers in batch.column(0).to_pylist():
            out = np.maximum(out, np.frombuffer(registers, np.uint8))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out))), pa.array(out.astype(np.int64))], ["at", "register"])


def estimate_grams(chunks: DataFrame) -> float:
    """Distinct n-grams of all texts; the sketch that comes to the driver has one size."""
    found = chunks.select("registers").mapInArrow(_registers, "at long, register long").groupBy("at").agg(F.max("register").alias("register")).toArrow()
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    out[found["at"].to_numpy()] = found["register"].to_numpy()
    return distinct(out)


def _flags(members):
    """The places of one chunk's trusted documents, as bits."""
    import pyarrow as pa

    at = members.column("at").to_numpy()
    bits = np.zeros(at.max() + 1, np.uint8)
    bits[at] = 1
    return pa.table({"chunk": members.column("chunk")[:1], "trusted": pa.array([np.packbits(bits).tobytes()], pa.binary()),
                     "n_target": pa.array([int(members.column("grams").to_numpy().sum())])})


def _unpack(docs, trusted: bytes | None):
    """The documents of a chunk: ids, texts (still Arrow's), flags."""
    import pyarrow as pa

    found = pa.ipc.open_stream(docs).read_all()
    set_bits = np.unpackbits(np.frombuffer(trusted or b"", np.uint8))[:len(found)]
    flags = np.zeros(len(found), bool)
    flags[:len(set_bits)] = set_bits
    return found.column(0), found.column(1), flags


class _Found:
    """The buckets of a chunk's documents, one after the other in one array."""

    def __init__(self, grams: list[int], bits: int):
        self.all = np.zeros(sum(grams), np.uint32 if bits <= 32 else np.uint64)
        self.ends = np.cumsum([0, *grams]).tolist()
        self.bits = bits

    def __getitem__(self, i: int) -> np.ndarray:
        return self.all[self.ends[i]:self.ends[i + 1]]

    def put(self, i: int, ids: np.ndarray, words: list[bytes]):
        self[i][:] = buckets(ids, words, self.bits)


def _ask(bits: int, n_parts: int):
    """The buckets of each chunk with their counts there, a row for each part."""
    bounds = np.array([(i << bits) // n_parts for i in range(1, n_parts)], np.uint64)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for chunk, grams, docs, trusted in zip(*(batch.column(i) for i in range(4))):
                _, texts, flags = _unpack(docs.as_buffer(), trusted.as_py())
                found = _Found(grams.as_py(), bits)
                for i, text in enumerate(texts):
                    found.put(i, *word_ids(text.as_py()))
                del texts
                some, n = runs(np.concatenate([found.all[:0], *(found[i] for i in np.flatnonzero(flags))]))
                known, raw = runs(found.all)
                target = np.zeros(len(known), np.int64)
                target[np.searchsorted(known, some)] = n
                cuts = np.searchsorted(known, bounds.astype(known.dtype)).tolist()
                rows = [(k, a, b) for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(known)])) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _, _ in rows], pa.int64()), pa.array([chunk.as_py()] * len(rows), pa.int64()),
                     pa.array([to_planes(np.diff(known[a:b].astype(np.uint64), prepend=np.uint64(0))) for _, a, b in rows], pa.binary()),
                     pa.array([to_pairs(raw[a:b], target[a:b]) for _, a, b in rows], pa.binary())],
                    ["part", "chunk", "buckets", "counts"])

    return run


def _total(asked):
    """One part: what the chunks asked for, with the counts of all chunks."""
    import pyarrow as pa

    each = [np.cumsum(from_planes(x.as_py()), dtype=np.uint64) for x in asked.column("buckets")]
    known, at = np.unique(np.concatenate(each), return_inverse=True)
    ends = np.cumsum([len(x) for x in each])[:-1]
    counts = [from_pairs(x.as_py()) for x in asked.column("counts")]
    totals = (np.bincount(at, np.concatenate(x), len(known)).astype(np.int64)[at] for x in zip(*counts))
    out = pa.array([to_pairs(*x) for x in zip(*(np.split(x, ends) for x in totals))], pa.binary())
    return pa.Table.from_arrays([asked.column("part"), asked.column("chunk"), out], ["part", "chunk", "counts"])


def trusted_ids(labels: DataFrame, id_col: str) -> DataFrame:
    """(_id) of all ids with label 1 that aren't toxic."""
    return (labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select(F.col(id_col).alias("_id"))
            .where("_id IS NOT NULL").distinct())


def log_ratio(found: np.ndarray, trusted: bool, known: np.ndarray, raw: np.ndarray, target: np.ndarray, scale: float) -> float:
    """Mean log-likelihood ratio of a text's n-grams, against all other texts; ``raw`` and ``target``
    are the counts of the buckets ``known``, which are in order."""
    if not len(found) or not scale:
        return 0.0
    used, own = np.unique(found, return_counts=True)
    at = np.searchsorted(known, used)
    t = target[at] - own if trusted else target[at]
    return float(own @ (np.log(t + SMOOTHING) - np.log((raw[at] - own) * scale + SMOOTHING)) / len(found))


def _judge(bits: int, scale: float, threshold: float, id_col: str):
    """One chunk with the totals of its buckets: a row for each document."""
    def run(chunk, totals):
        import pyarrow as pa

        doc_ids, texts, trusted = _unpack(chunk.column("docs")[0].as_buffer(), chunk.column("trusted")[0].as_py())
        rows, found = [], _Found(chunk.column("grams")[0].as_py(), bits)
        for i, text in enumerate(texts):
            text = text.as_py()
            ids, words = word_ids(text)
            rows.append(base_measures(text, ids, len(words)))
            found.put(i, ids, words)
        del texts
        known = runs(found.all.copy())[0]
        counts, start, end = np.zeros((2, len(known)), np.uint32), 0, 0
        for data in totals.sort_by("part").column("counts"):
            part = np.stack(from_pairs(data.as_py()))
            end = start + part.shape[1]
            if end > len(known):
                break
            if part.max() >> 32 and counts.dtype == np.uint32:
                counts = counts.astype(np.int64)
            counts[:, start:end] = part
            start = end
        if end != len(known):
            raise RuntimeError("the totals of a chunk are not those of its buckets")
        scores = np.array([log_ratio(found[i], flag, known, *counts, scale) for i, flag in enumerate(trusted)], float)
        n = np.array(rows, np.int64).reshape(-1, len(BASE))
        failed = (n[:, 0] < MIN_WORDS) | (100 * n[:, 4] > MAX_REPEAT_PERCENT * n[:, 0])
        return pa.Table.from_arrays([doc_ids, *map(pa.array, n.T), pa.array(failed), pa.array(scores), pa.array(~failed & (scores >= threshold))],
                                    [id_col, *BASE, "base_failed", "llr", "kept"])

    return run


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: id, the base measures, base_failed, llr, kept.

    Null and empty texts have no words (base_failed).  Null ids stay and are never trusted;
    repeated rows each count and each get a row; null labels are no labels; other columns are
    ignored; an empty table gives an empty result.  Without trusted rows every llr is 0, so the
    base rules decide alone.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    size = texts.select(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    texts = texts.coalesce(max(MIN_TASKS, -(-size // CHUNK_BYTES)))
    chunks = texts.mapInArrow(_pack, f"chunk long, ids array<{id_type(docs, id_col)}>, grams array<long>, registers binary, docs binary")
    buckets = max(1, min(MAX_FILES, CHUNKS_A_TASK * texts.rdd.getNumPartitions()))
    chunks = materialize_by(chunks, "chunks", "chunk", buckets)  # the totals come to the chunks, which stay where they are
    members = (chunks.select("chunk", "grams", F.posexplode("ids").alias("at", "_id")).select("chunk", "_id", "at", F.get("grams", "at").alias("grams"))
               .join(trusted_ids(labels, id_col), "_id"))
    flags = materialize(members.select("chunk", "at", "grams").groupBy("chunk").applyInArrow(_flags, "chunk long, trusted binary, n_target long"), "flags")
    raw = chunks.select(F.sum(F.aggregate("grams", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    target = flags.agg(F.sum("n_target")).first()[0] or 0
    flagged = chunks.select("chunk", "grams", "docs").join(flags.select("chunk", "trusted"), "chunk", "left").select("chunk", "grams", "docs", "trusted")
    bits, n_parts = bucket_bits(estimate_grams(chunks)), max(MIN_PARTS, -(-raw // PART_GRAMS))
    asked = flagged.mapInArrow(_ask(bits, n_parts), "part long, chunk long, buckets binary, counts binary")
    totals = asked.groupBy("part").applyInArrow(_total, "part long, chunk long, counts binary")
    schema = f"`{id_col}` {id_type(docs, id_col)}, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, llr double, kept boolean"
    return (flagged.groupBy("chunk").cogroup(totals.groupBy("chunk"))
            .applyInArrow(_judge(bits, target / raw if raw else 0.0, threshold, id_col), schema))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and likelihood ratio of every document."""
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
