"""Embedding near-dedup, conversation repair, source divergence: brute force and hostile rows."""

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from bizlens.llm import conversation_repair, cover_tree, source_divergence
from bizlens.llm.common import table
from bizlens.llm.conversation_repair import EXPECTED, STEP, SuffixAutomaton
from bizlens.llm.cover_tree import CoverTree, DualTraversal, unit_rows
from bizlens.llm.source_divergence import Transducer, terms_of

SF001 = "/root/testdata/sf0.001"


def classes_of(n, edges):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


# embedding near-dedup

def _clouds(rng, n, width):
    """Vectors with groups of all widths: copies, tight and loose clouds, lone ones."""
    x = rng.normal(size=(n, width))
    own = n // 2
    centres = x[rng.integers(0, max(1, min(3, n)), own)]
    x[:own] = centres + rng.normal(size=centres.shape) * rng.choice([0, 0.03, 0.15, 0.25], size=(own, 1))
    return x


@pytest.mark.parametrize("seed", range(12))
def test_dual_traversal_matches_all_pairs(seed):
    rng = np.random.default_rng(seed)
    width, n, threshold = int(rng.choice([1, 2, 3, 8, 64])), int(rng.integers(1, 600)), float(rng.choice([0.95, 0.8, 0.99]))
    units = unit_rows(_clouds(rng, n, width))
    tree = CoverTree(units)
    # the tree: nested ranges, centres first, everything within the radius
    for node in range(len(tree.begin)):
        own = tree.vectors[tree.begin[node]:tree.end[node]]
        assert np.sqrt(np.maximum(0, 2 - 2 * (own @ own[0]))).max() <= tree.radius[node] + 1e-9
        begins, ends, radii, nodes = tree.parts(node)
        assert begins[0] == tree.begin[node] and ends[-1] == tree.end[node] and (begins[1:] == ends[:-1]).all()
    links, child, root = DualTraversal(CoverTree.from_bytes(tree.to_bytes(), tree.vectors), None, threshold).result()
    near = tree.vectors @ tree.vectors.T >= threshold
    np.fill_diagonal(near, False)
    assert (links == near.sum(axis=1)).all()
    assert classes_of(n, zip(child, root)) == classes_of(n, np.argwhere(near))
    cut = n // 3
    if cut:
        left, right = CoverTree(units[:cut]), CoverTree(units[cut:])
        links, child, root = DualTraversal(left, right, threshold).result()
        both = np.concatenate([left.vectors, right.vectors])
        near = both @ both.T >= threshold
        near[:cut, :cut] = near[cut:, cut:] = False
        assert (links == near.sum(axis=1)).all()
        assert classes_of(n, zip(child, root)) == classes_of(n, np.argwhere(near))


def _links_by_force(rows, threshold):
    """rows: (id, vector); the query's columns, in the order of the rows."""
    n, edges = len(rows), []
    good = [v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v) for _, v in rows]
    for i, j in itertools.combinations(range(n), 2):
        a, b = rows[i][1], rows[j][1]
        if good[i] and good[j] and len(a) == len(b):
            a, b = (np.array(x, float) / max(map(abs, x)) for x in (a, b))
            if a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                edges.append((i, j))
    degree, root = Counter(x for e in edges for x in e), classes_of(n, edges)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root[i]] = min(least.get(root[i], key), key)
    return [(key, degree[i], least.get(root[i]), key == least.get(root[i])) for i, (key, _) in enumerate(rows)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embedding_query_by_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(_clouds(rng, 260, 6))]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 6), (1003, [1.0, None] * 3), (1004, [math.nan] + [1.0] * 5), (1005, [math.inf] + [1.0] * 5),
             (1006, [1.0, 0.0]), (1007, [2.0, 0.0]), (None, [1.0, 0.1]), (None, [0.0, 1.0]), (1008, [3.0]), rows[0], rows[0], (5, [-9.0] * 6), (-4, rows[1][1]),
             (1009, [1e-30, 0.0, 0.0]), (1010, [1e30, 0.0, 0.0]), (1010, [-1e30, 0.0, 0.0])]
    df = spark.createDataFrame([r + ("x", "y", 1) for r in rows], f"vec_id long, embedding array<{kind}>, row string, n string, u long").repartition(3)
    got = cover_tree.embedding_components(df, block_rows=40)
    assert got.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(_links_by_force(rows, 0.95), key=repr)
    assert cover_tree.embedding_components(df.limit(0)).collect() == []


def test_hot_group_and_labels(spark):
    """A third of all rows in one tight group, split over blocks; labels are not looked at."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 16))
    x[:300] = x[0] + rng.normal(size=(300, 16)) * 0.01
    df = spark.createDataFrame([(i, v.tolist(), i % 7) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, cover_tree.embedding_components(df, block_rows=64).collect()))
    assert got == sorted(_links_by_force([(i, v.tolist()) for i, v in enumerate(x)], 0.95))


# conversation repair

def best_audit(word):
    """Cheapest audit of a word, ASCII-least among equals, by Dijkstra over edits and whole strings."""
    done, heap = set(), [(0, "", 0, 0)]
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(word) and state in (0, 3):
            return cost, audit
        follow = [(cost + 3, audit + "I", at, STEP[state][r]) for r in "ua" if r in STEP[state]]
        if at < len(word):
            letter = word[at]
            extra = 3 if letter.isupper() else 0
            follow.append((cost + 4, audit + "D", at + 1, state))
            if letter != "-":
                follow += [(cost + extra, audit + "K", at + 1, STEP[state][letter.lower()])] if letter.lower() in STEP[state] else []
                follow += [(cost + extra + 3, audit + "R", at + 1, STEP[state][r]) for r in "ua" if r in STEP[state]]
        for x in follow:
            heapq.heappush(heap, x)


def test_automaton_gives_the_least_audit_and_shares_suffixes():
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("suaxSUAX-", k=rng.randrange(0, 9))) for _ in range(3000)})
    automaton = SuffixAutomaton()
    for backwards in words:
        assert automaton.word(backwards) == best_audit(backwards[::-1])
    assert automaton.made == len({w[:i] for w in words for i in range(1, len(w) + 1)})  # one node a suffix


def _damage(rows):
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        drawn = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        role = "user" if drawn == 4 else role
        for _ in range(0 if drawn == 0 else 2 if drawn == 3 else 1):
            yield conv, turn, role, text


def repair_by_force(original):
    by = defaultdict(list)
    for r in _damage(original):
        by[r[0]].append(r[1:])
    out = []
    for conv in {r[0] for r in original}:
        rows = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, word, faults, initials = set(), "", Counter(), [r[1][:1] for r in rows]
        for _, role, text in rows:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            word += "-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        turns = {r[0] for r in rows} - {None}
        cost, audit = best_audit(word)
        state, at, kept = 0, 0, []
        for edit in audit:
            if edit != "D":
                initial = rows[at][1][:1] if edit == "K" else EXPECTED[state]
                name = {"u": "user", "a": "assistant"}.get(initial)
                kept.append(f"{rows[at][1] if edit == 'K' else name}:{'' if edit == 'I' else rows[at][2]}")
                state = STEP[state][initial]
            at += edit != "I"
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_repair_by_brute_force(spark):
    rows = table(spark, SF001, "conversations").select("conv_id", "turn", "role", "text").collect()
    assert sorted(map(tuple, conversation_repair.op12_conversation_repair(spark, SF001).collect()), key=repr) == repair_by_force([tuple(r) for r in rows])


def test_repair_of_hostile_conversations(spark):
    rng = random.Random(8)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "User", "assistant", "user", "été"]
    texts = ["Yes.", "no", "", None, " \t\n", "done! ", "a.b", "?", "Yes.", "é中.", "x" * 50_000 + ".", ". " * 20_000 + "x", "line\nuser:two."]
    rows = [(rng.choice([*range(60), None]), rng.choice([*range(9), 2, 2, None]), rng.choice(roles), rng.choice(texts)) for _ in range(900)]
    rows += [(100, t, "user" if t % 2 == 0 else "assistant", f"text {t}.") for t in range(700)]  # a long one
    rows += [(101, None, None, None)] * 3 + [(102 + i, 0, "user", "hi.") for i in range(60)]  # some lose all their rows
    df = spark.createDataFrame([r + ("x", "y", "z", 1) for r in rows], "conv_id long, turn long, role string, text string, id string, audit string, word string, cost int").repartition(4)
    got = conversation_repair.repair_report(df)
    assert got.dtypes == [("conv_id", "bigint"), *((c, "bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                          ("audit", "string"), ("repaired_sha256", "string")]
    want = repair_by_force(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert any(w[7] == "" and w[8] == hashlib.sha256(b"").hexdigest() for w in want)
    assert conversation_repair.repair_report(df.limit(0)).collect() == []


def test_repaired_turns_are_rows(spark):
    rows = [(1, 0, "assistant", "hello."), (1, 1, "user", "what"), (1, 2, "user", "so?"), (1, 3, "assistant", " "), (1, 4, "assistant", "that.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    audits = conversation_repair.conversation_audits(df)
    found = audits.first()
    assert (found.cost, found.audit) == best_audit("aUu-a") and (found.blank, found.truncated, found.illegal) == (1, 1, 2)
    turns = sorted(map(tuple, conversation_repair.repaired_turns(df, audits).collect()))
    assert [t[1] for t in turns] == list(range(len(turns)))
    assert re.fullmatch("s?(ua)+", "".join(t[3][0] for t in turns))


# source divergence

def test_transducer_is_minimal_and_gives_ordinals():
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abcé中z", k=rng.randrange(1, 7))).encode() for _ in range(3000)})
    kept = sorted(rng.sample(words, 1500))
    found = Transducer.from_bytes(Transducer(kept).to_bytes())
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    place = {w: i for i, w in enumerate(kept)}
    assert found.ordinals(np.frombuffer(b" ".join(words), np.uint8), begins, ends).tolist() == [place.get(w, -1) for w in words]
    # minimal: no two states have the same continuations
    right = defaultdict(set)
    for w in kept:
        for i in range(len(w) + 1):
            right[w[:i]].add(w[i:])
    assert len(found.finals) == len({frozenset(x) for x in right.values()})
    assert Transducer([]).ordinals(np.frombuffer(b"a", np.uint8), np.array([0]), np.array([1])).tolist() == [-1]


@pytest.mark.parametrize("window", [1, 7, 64, 1 << 20])
def test_terms_of_neighbouring_texts(monkeypatch, window):
    monkeypatch.setattr(source_divergence, "WINDOW", window)
    rng = random.Random(window)
    texts = ["".join(rng.choices("aB é.中\n", k=rng.randrange(0, 30))).encode() for _ in range(200)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    got = [(int(k), bytes(part[a:b])) for part, begins, ends, text in terms_of(data, np.cumsum([0, *map(len, texts)])) for a, b, k in zip(begins, ends, text)]
    assert got == [(i, t) for i, text in enumerate(texts) for t in re.findall(rb"[A-Za-z\x80-\xff]+", text.lower())]


def divergence_by_force(rows, min_docs, top=50):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))) for lang, source, text in rows]
    held = defaultdict(Counter)
    for lang, _, words in docs:
        held[lang].update(set(words))
    kept = {lang: sorted((t for t, n in c.items() if n >= min_docs), key=str.encode) for lang, c in held.items()}
    counts, groups = defaultdict(Counter), sorted({d[:2] for d in docs})
    for lang, source, words in docs:
        known = set(kept[lang])
        own = [w for w in words if w in known]
        counts[lang, source].update(own)
        counts[lang].update(own)

    def p(key, term, v):
        return 1 + 1_000_000_000 * (counts[key][term] + 5) // (sum(counts[key].values()) + 5 * v)

    out = []
    for lang, source in groups:
        v = len(kept[lang])
        pairs = [(-sum(abs(p((lang, source), t, v) - p((lang, s), t, v)) for t in kept[lang]), s.encode(), s) for g, s in groups if g == lang and s != source]
        terms = [(p(lang, t, v) - p((lang, source), t, v), t.encode(), t) for t in kept[lang] if counts[lang, source][t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(x for x in terms if x[0] < 0)[:top])):
            out += [(lang, source, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def test_divergence_by_brute_force(spark, monkeypatch):
    for name, value in (("BLOCK_TERMS", 4), ("TILE_SOURCES", 2), ("PASS_BYTES", 900), ("HELD", 50)):
        monkeypatch.setattr(source_divergence, name, value)
    rng = random.Random(6)
    words = "Alpha beta gamma été niño straße 中文 don't x1y2 z_z ǅ ß".split() + [f"w{c}" for c in "abcdefghij"]
    rows = [(rng.choice(["en", "de", None, "zz"]), rng.choice(["s1", "s2", "S3", None, "é", "s5"]), " ".join(rng.choices(words, k=rng.randrange(0, 12)))) for _ in range(300)]
    rows += [("only", "a", ""), ("only", "b", None), ("single", "a", "alpha " * 9), ("en", "s1", "a" * 300_000), ("en", "s2", "beta " * 30_000)] + [rows[0]] * 3
    df = spark.createDataFrame([r + ("q", 1, 2) for r in rows], "lang string, source string, text string, term string, n int, ordinal int").repartition(3)
    got = source_divergence.source_divergence(df, min_docs=4, shard_terms=5)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == divergence_by_force(rows, 4)
    assert source_divergence.source_divergence(df.limit(0)).collect() == []


def test_whole_probabilities():
    n, total = np.array([0, 1, 7, 123_456_789_012]), np.array([10, 5, 10**12, 200_000_000_000_000])
    assert source_divergence.whole_probabilities(n, total, 3).tolist() == [1 + 10**9 * (int(a) + 5) // (int(b) + 15) for a, b in zip(n, total)]
