"""Order-preserving packing of documents into sequences by dynamic programming.

Documents stay in the order in which they are stored.  Windows of at most ``width`` tokens are
cut at document or sentence ends (and, inside passages without such ends, at fixed steps), so
that padding plus truncation penalties are least.  With ``p`` the position of a cut, a window
from cut i to cut j costs ``width - (p_j - p_i) + penalty_j``, so the best cost of j is a
minimum of ``cost_i + p_i`` over the cuts within ``width``: a monotone queue gives it in
constant amortised time.  Lengths that are a power of two need no padding; those from
``SHORT`` up are tried beside the queue.

Each Spark task packs the rows of its own input split: no shuffle, bounded memory, and a task
that runs again gives the same rows.  Sequence ids are (partition id << 33) + number.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import id_type, ship_package, table, text_or_empty
from bizlens.llm.tokens import batches, encoder

TOKENIZER = "byte_bpe_50k.json"
WIDTH = 1024
END_ID = 0  # closes each document
SENTENCE_PENALTY = 6  # tokens of padding that cutting a document at a sentence's end is worth
STEP_PENALTY = 24  # the same for a cut inside a sentence
STEP = 32  # tokens between cuts where no sentence ends
SHORT = 256  # shortest power of two used as a window without padding
BLOCK_TOKENS = 1 << 18  # tokens packed at once; the last window moves into the next block


def sentence_end_table(tokenizer: str) -> np.ndarray:
    """For each id of the vocabulary, if a sentence or line ends with it."""
    tok = encoder(tokenizer).tokenizer
    texts = tok.decode_batch([[i] for i in range(tok.get_vocab_size(with_added_tokens=True))], skip_special_tokens=False)
    return np.array(["\n" in t or t.rstrip("\"')]").endswith((".", "!", "?", "…", "。")) for t in texts], bool)


def candidate_cuts(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a window may end, in order, and their penalties; 0 and the total are in."""
    total = len(ids)
    penalty = np.full(total + 1, -1, np.int32)
    penalty[1:][ends[ids]] = SENTENCE_PENALTY
    penalty[doc_ends] = 0
    penalty[0] = 0
    at = np.flatnonzero(penalty >= 0)
    wide = np.flatnonzero(np.diff(at) > STEP)
    for a, b in zip(at[wide].tolist(), at[wide + 1].tolist()):
        penalty[a + STEP:b:STEP] = STEP_PENALTY
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def best_cuts(at: np.ndarray, penalty: np.ndarray, width: int = WIDTH) -> list[int]:
    """Positions of the cheapest windows' ends (the first is 0, the last the total).

    ``at`` holds the candidates in order, with gaps of at most ``width``."""
    p, pen, n = at.tolist(), penalty.tolist(), len(at)
    where = np.full(p[-1] + 1, -1, np.int64)
    where[at] = np.arange(n)
    powers = [1 << k for k in range(32) if SHORT <= 1 << k < width]
    exact = [np.where(at >= w, where[np.maximum(at - w, 0)], -1).tolist() for w in powers]
    key, back = [0] * n, [0] * n  # key: best cost plus position
    queue: deque[int] = deque([0])
    for j in range(1, n):
        here = p[j]
        while p[queue[0]] < here - width:
            queue.popleft()
        i = queue[0]
        cost = key[i] + width - here
        for x in exact:
            if (k := x[j]) >= 0 and key[k] - p[k] < cost:
                i, cost = k, key[k] - p[k]
        back[j] = i
        key[j] = k = cost + pen[j] + here
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return [p[i] for i in reversed(cuts)]


class _Packer:
    """Packs (id, bytes of ids) in order; holds one block."""

    def __init__(self, ends: np.ndarray, width: int, first_sequence: int):
        self.ends, self.width, self.sequence = ends, width, first_sequence
        self.held: list[tuple] = []  # id, tokens of the document, start in it, bytes
        self.size = 0

    def add(self, doc_id, ids: bytes):
        self.held.append((doc_id, len(ids) // 4, 0, ids))
        self.size += len(ids) // 4

    def pack(self, last: bool) -> list[tuple]:
        """Rows of the windows that are settled; all of them at the end."""
        if not self.held:
            return []
        ids = np.frombuffer(b"".join(x[3] for x in self.held), "<u4")
        doc_ends = np.cumsum([len(x[3]) // 4 for x in self.held])
        cuts = best_cuts(*candidate_cuts(ids, doc_ends, self.ends), self.width)
        if not last and len(cuts) > 2:
            cuts.pop()
        rows, rest, start, w = [], [], 0, 1
        for doc_id, n, begin, data in self.held:
            end, at = start + len(data) // 4, start
            while at < end and w < len(cuts):
                upto = min(end, cuts[w])
                piece = data[(at - start) * 4:(upto - start) * 4]
                rows.append((doc_id, begin + at - start, upto - at, zlib.crc32(piece), n, self.sequence + w - 1, at - cuts[w - 1]))
                at = upto
                if at == cuts[w]:
                    w += 1
            if at < end:
                rest.append((doc_id, n, begin + at - start, data[(at - start) * 4:]))
            start = end
        self.sequence += len(cuts) - 1
        self.held, self.size = rest, sum(len(x[3]) // 4 for x in rest)
        return rows


def _pack(tokenizer: str, width: int, id_col: str):
    def run(parts):
        import pyarrow as pa
        from pyspark import TaskContext

        enc, ends = encoder(tokenizer), sentence_end_table(tokenizer)
        packer = _Packer(ends, width, TaskContext.get().partitionId() << 33)
        close = np.array([END_ID], "<u4").tobytes()
        kind = pa.int64()

        def out(rows):
            names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kind)] + [pa.array(c, pa.int64()) for c in columns[1:]], [id_col, *names])

        for part in parts:
            kind = part.column(0).type
            doc_ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for s in batches(texts):
                for doc_id, ids in zip(doc_ids[s], enc.encode(texts[s])):
                    packer.add(doc_id, ids + close)
                    if packer.size >= BLOCK_TOKENS and (rows := packer.pack(False)):
                        yield out(rows)
        while packer.held:
            yield out(packer.pack(True))

    return run


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, width: int = WIDTH,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and then ``END_ID``.  Null and empty texts are that id alone; repeated
    rows are documents of their own; null ids stay; other columns are ignored; an empty table
    gives no rows; a long text runs over as many windows as it needs.
    """
    ship_package(docs.sparkSession)
    schema = (f"`{id_col}` {id_type(docs, id_col)}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long")
    return docs.select(F.col(id_col), text_or_empty(text_col).alias("_text")).mapInArrow(_pack(tokenizer, width, id_col), schema)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
