"""Conversation repair, MinHash near-dedup and the prefix trie against brute force."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import Row

from stockpulse.llm import minhash, prefix_trie, queries, repair

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _turns(rows):
    """Rows of a conversation by turn, nulls first."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r, x))
    return {c: sorted(v, key=lambda k: (k[0] is not None, k[0] or 0)) for c, v in by.items()}


@pytest.fixture(scope="module")
def rows():
    return duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()


#: Odd rows of conversations; ties of a turn are equal rows, so every order is the same.
ODD = [(50, 0, "user", "Hi there."), (50, 0, "user", "Hi there."), (50, None, "system", "Be kind."), (50, 3, None, "what?"), (50, 4, "assistant", None),
       (51, 0, None, None), (52, None, "user", ""), (60, 1, "user", "a b c."), (60, 2, "assistant", "x " * 30_000 + "end."), (61, 1, "user", "a b c."),
       (61, 2, "assistant", "cut short"), (61, 2, "assistant", "cut short"), (62, 9, "tool", "odd!"), (63, 0, "assistant", "One."), (63, 7, "user", "Two."),
       (None, 0, "user", "no id."), (None, 1, "assistant", "still none."), *[(64, t, "user" if t % 2 else "assistant", f"t{t % 50}.") for t in range(700)],
       *[(65, t, "user" if t % 2 else "assistant", f"t{t % 50}.") for t in range(690)], *[(66, t, "user" if t % 2 == 0 else "assistant", f"n {t}.") for t in range(300)]]


@pytest.fixture(scope="module")
def odd_turns(spark):
    made = [Row(conv_id=c, turn=t, role=r, text=x, words=1, id="q", copies=None, key="k", n=3, h1=1, symbol=0, audit="Z", place=5) for c, t, r, x in ODD]
    return spark.createDataFrame(made, "conv_id long, turn long, role string, text string, words long, id string, copies long, key string, n long, h1 long, symbol long, audit string, place long").repartition(3)


def _brute_repair(rows):
    out = {c: None for c, *_ in rows}
    hurt = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        hurt += [(c, t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    by = _turns(hurt)
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    for c in out:
        mine, seen, faults = by.get(c, []), set(), []
        for _, r, x in mine:
            body = re.findall(r"[^\x20\x09-\x0D]", x)
            faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((r, x))
        initials = [r[:1] for _, r, _ in mine]
        turns = [t for t, _, _ in mine if t is not None]
        heap, done = [(0, "", 0, 0, ())], set()
        while True:
            cost, audit, i, q, kept = heapq.heappop(heap)
            if i == len(mine) and q in (0, 3):
                break
            if (i, q) in done:
                continue
            done.add((i, q))
            name = {2: "user", 3: "assistant"}[after[q]]
            heapq.heappush(heap, (cost + 5, audit + "I", i, after[q], kept + (f"{name}:",)))
            if i < len(mine):
                heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q, kept))
                if faults[i] not in ("blank", "duplicate"):
                    late = 5 * (faults[i] == "truncated")
                    if initials[i] == "s" and q == 0:
                        heapq.heappush(heap, (cost + late, audit + "K", i + 1, 1, kept + (f"{mine[i][1]}:{mine[i][2]}",)))
                    if initials[i] == name[0]:
                        heapq.heappush(heap, (cost + late, audit + "K", i + 1, after[q], kept + (f"{mine[i][1]}:{mine[i][2]}",)))
                    heapq.heappush(heap, (cost + late + 1, audit + "R", i + 1, after[q], kept + (f"{name}:{mine[i][2]}",)))
        out[c] = ((max(turns) - min(turns) + 1 - len(set(turns))) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def _repaired(df):
    got = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: tuple(r)[1:] for r in got}


def test_repair_query(spark, rows):
    assert _repaired(queries.op11_conversation_repair(spark, SF)) == _brute_repair(rows)


def test_repair_odd_rows(spark, odd_turns):
    got, expected = _repaired(repair.repair(repair.damage(odd_turns))), _brute_repair(ODD)
    # ties of turn with different rows have a stated order of their own; ODD has equal ones only
    assert got == expected
    assert repair.repair(repair.damage(odd_turns.limit(0))).count() == 0


@pytest.mark.parametrize("block", [1, 3, 4])
def test_block_tables(block):
    tables, rng = repair.BlockTables(block), random.Random(block)
    one = repair.BlockTables(1)
    for _ in range(300):
        word = bytes(rng.choice([0, 2, 4, 2, 4, 3, 5, 6, 8, rng.randrange(9)]) for _ in range(rng.randrange(40)))
        assert tables.repair(word) == one.repair(word)


def test_repaired_rows(spark):
    """The operator's own output: the language holds, edits are those of the audit."""
    turns = spark.createDataFrame([(1, 0, "user", "Hello."), (1, 1, "user", "Again."), (1, 2, "assistant", ""), (2, 0, "system", "S."), (2, 1, "assistant", "A.")],
                                  "conv_id long, turn long, role string, text string")
    plain = repair.undamaged(turns)
    found = repair.audits(plain)
    got = [tuple(r) for r in repair.repaired(plain, found).orderBy("conv_id", "position").collect()]
    # "Again." becomes the answer (1) and the blank row goes (2); the system row becomes the question (1)
    assert got == [(1, 0, "K", "user", "Hello."), (1, 1, "R", "assistant", "Again."), (2, 0, "R", "user", "S."), (2, 1, "K", "assistant", "A.")]
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in found.collect()} == {1: (3, "KRD"), 2: (1, "RK")}


def _brute_trie(rows, rebuilt=True):
    by = {c: [("" if r is None else r, "" if x is None else x) for _, r, x in v] for c, v in _turns(rows).items()}
    seqs = {}
    for c, own in by.items():
        h = zlib.crc32(b"" if c is None else str(c).encode()) % 4
        base = by.get(c - c % 20, []) if c is not None else []
        seqs[c] = tuple(base[:h] + own[h:]) if rebuilt else tuple(own)
    nodes = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
    name = {p: min((c for c in m if c is not None), default=None) for p, m in nodes.items()}
    out = []
    for p, m in nodes.items():
        ends = sorted((c for c in m if len(seqs[c]) == len(p)), key=lambda c: (c is not None, c or 0))
        digest = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        out.append((name[p], len(p), name[p[:-1]] if p else None, len(m), kids[p], leaves[p], saved[p], digest))
    return sorted(out, key=lambda r: (r[1], r[0] is not None, r[0] or 0))


def _nodes(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()), key=lambda r: (r[1], r[0] is not None, r[0] or 0))


def test_trie_query(spark, rows):
    assert _nodes(queries.op13_prefix_trie(spark, SF)) == _brute_trie(rows)


@pytest.mark.parametrize("chunk", [4, 256])
def test_trie_odd_rows(spark, odd_turns, chunk):
    """Conversations over several chunks, copies of them, a null id, and conversations without turns after the rebuild."""
    got = prefix_trie.prefix_trie(prefix_trie.rebuild(prefix_trie.in_order(prefix_trie.encode(odd_turns))), chunk)
    assert _nodes(got) == _brute_trie(ODD)


def test_trie_shared_prefixes(spark):
    """Prefixes shared over shards, sequences that go on in the next shard, and copies: with more shards than sequences, too."""
    rng = random.Random(5)
    rows = []
    for c in range(120):
        s = [("u", f"w{rng.randrange(2)} and {rng.randrange(2)}") for _ in range(rng.randrange(1, 9))]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(s)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            for chunk in (3, 64):
                got = prefix_trie.prefix_trie(prefix_trie.in_order(prefix_trie.encode(turns)), chunk)
                assert _nodes(got) == _brute_trie(rows, rebuilt=False)
        assert prefix_trie.prefix_trie(prefix_trie.rebuild(prefix_trie.in_order(prefix_trie.encode(turns.limit(0))))).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _brute_minhash(docs, shingle=2):
    sets = []
    for d, t in docs:
        w = WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), t or ""))
        k = min(shingle, len(w))
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset())
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)].append(d)
    out = []
    for i, (d, _) in enumerate(docs):
        c = min(least[root(i)], default=None) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def test_minhash_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = sorted(map(tuple, queries.op12_minhash(spark, SF).collect()), key=repr)
    assert got == _brute_minhash(docs)


def test_minhash_chains(spark):
    """Chains and groups of near copies around the threshold, beside texts that share most of their common phrases; tiny blocks."""
    rng = random.Random(3)
    texts = []
    for g in range(12):
        base = [f"w{rng.randrange(40)}" for _ in range(rng.choice([3, 6, 12, 40, 150, 400]))]
        for _ in range(9):
            now = list(base)
            for _ in range(rng.randrange(0, 1 + len(now) // 7)):
                now[rng.randrange(len(now))] = f"x{rng.randrange(1000)}"
            texts.append(" ".join(now))
            if rng.random() < 0.4:
                base = now
    passage = " ".join(f"common{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"own{k}_{i}" for i in range(rng.choice([4, 10, 20, 30]))) for k in range(30)]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, minhash.components(df, cell=4).collect()), key=repr) == _brute_minhash(docs)


def test_minhash_large_groups(spark, monkeypatch):
    """No table grows with the square of a group of texts just below the threshold; long texts around it, whose sketches are a part of their sets."""
    rng = random.Random(5)

    def changed(words, times):
        now = list(words)
        for _ in range(times):
            now[rng.randrange(len(now))] = f"x{rng.randrange(10 ** 6)}"
        return " ".join(now)

    base = [f"w{k}" for k in range(100)]
    texts = [changed(base, 5) for _ in range(400)]
    for g, (times, copies) in enumerate(((40, 5), (80, 5), (90, 5), (160, 5))):
        base = [f"v{g}_{k}" for k in range(1500)]
        texts += [" ".join(base)] + [changed(base, times) for _ in range(copies)]
    docs = list(enumerate(texts))
    rows, written = {}, minhash.written

    def counted(df, name, **options):
        out = written(df, name, **options)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(minhash, "written", counted)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, minhash.components(df).collect()), key=repr) == _brute_minhash(docs)
    assert max(rows.values()) <= 72 * len(docs), rows


def test_minhash_odd_rows(spark, odd):
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    got = sorted(map(tuple, minhash.components(odd).collect()), key=repr)
    assert got == _brute_minhash(docs)
    assert minhash.components(odd.limit(0)).count() == 0
