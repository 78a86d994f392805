"""Every operator against a brute-force version, an exact round trip or held-out accuracy."""

import hashlib
import math
import random
import re
import timeit
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from stockpulse.llm import chat, decontaminate, langid, lines, ngram_lm, packing, queries, simhash, spotsigs, token_files, tokens, toxicity
from stockpulse.llm.common import connected_components
from stockpulse.llm.elias_fano import EliasFano
from stockpulse.llm.tokens import Encoder, default_tokenizer

SF = "/root/testdata/sf0.001"


def plain_tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return t


def fold_of(i, k):
    return zlib.crc32(b"" if i is None else str(i).encode()) % k


def u32(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], list(range(100)), [0, 2 ** 40, 2 ** 62], sorted(np.random.default_rng(1).integers(0, 10 ** 9, 5000).tolist())])
def test_elias_fano(values):
    ef = EliasFano(EliasFano.encode(np.array(values, "u8")))
    assert ef.all().tolist() == values
    assert ef.select(np.arange(len(values))).tolist() == values
    asked = np.array(sorted({*values, *(v + 1 for v in values), 7, 2 ** 63}), "u8")
    got = ef.find(asked)
    assert [values[g] if g >= 0 else None for g in got] == [int(a) if int(a) in set(values) else None for a in asked]


def test_encoder_is_the_tokenizer(docs, odd):
    texts = [r["text"] or "" for r in docs.union(odd.select(docs.columns)).collect()]
    enc, plain = Encoder(default_tokenizer()), plain_tokenizer()
    assert enc.encode(texts) == [u32(plain.encode(t, add_special_tokens=False).ids) for t in texts]


def test_encoder_learns_each_part_once(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 200)
    enc, plain, asked = Encoder(default_tokenizer()), plain_tokenizer(), []
    learn = enc._learn
    monkeypatch.setattr(enc, "_learn", lambda parts, cache, lead: (asked.extend(lead + w for w in parts), learn(parts, cache, lead)))
    text = "a house house. house, house!\nhouse (house) don't. don't\nIt's house...\nhouse"
    assert enc.encode([text, "", text]) == [u32(plain.encode(t, add_special_tokens=False).ids) for t in (text, "", text)]
    assert asked.count(" house") == 1 and " house." not in asked and asked.count("house") == 1
    rng = random.Random(4)
    some = ["a", "the", "is", "don't", "'s", "'", "x'", "\n", "\n\n", " ", "  ", ".", ",", "...", "é", "ß", "漢字", "123", "\t", "\u00a0", "\u3000", "\x1c", "\r\n",
            "<|endoftext|>", "***", "_", "The", "\U0001F600", "\u0301", "\u0120", "\u0120x", "-", "\"", "\u017f", "\x00"]
    for _ in range(20):
        texts = ["".join(rng.choice(some) if rng.random() < 0.8 else " " for _ in range(rng.randrange(40))) for _ in range(100)]
        assert enc.encode(texts) == [u32(plain.encode(t, add_special_tokens=False).ids) for t in texts]


def test_select_in_word():
    rng = np.random.default_rng(1)
    words = np.concatenate([rng.integers(0, 2 ** 64, 200, dtype="u8"), np.array([2 ** 64 - 1, 1, 2 ** 63], "u8")])
    list_ = EliasFano(EliasFano.encode(np.arange(3)))
    bits = [[i for i in range(64) if x >> i & 1] for x in words.tolist()]
    word, k = np.repeat(words, [len(b) for b in bits]), np.concatenate([np.arange(len(b)) for b in bits])
    assert list_._in_word(word, k).tolist() == sum(bits, [])

    def halved():
        pos, w, left = np.zeros(len(word), "u8"), word.copy(), k.astype("i8")
        for half in (32, 16, 8, 4, 2, 1):
            low = w & np.uint64((1 << half) - 1)
            c = np.bitwise_count(low).astype("i8")
            up = left >= c
            left, w, pos = np.where(up, left - c, left), np.where(up, w >> np.uint64(half), low), pos + np.where(up, np.uint64(half), np.uint64(0))

    word, k = np.tile(word, 10), np.tile(k, 10)
    # a fraction of the time that halving each word takes
    assert min(timeit.repeat(lambda: list_._in_word(word, k), number=3)) < 0.7 * min(timeit.repeat(halved, number=3))


def test_components_of_edges(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(-50, 50, (70, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {x: x for p in pairs for x in p if p[0] != p[1]}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        if a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: root(x) for x in up}


# 1: line dedup

@pytest.mark.parametrize("sf", [SF])
def test_line_dedup_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.sql(lines.ORACLE_SQL).fetchall())
    got = sorted(tuple(r) for r in queries.op1_line_dedup(spark, sf).select("doc_id", "text", "n_lines", "n_dropped").collect())
    assert got == want


def test_line_dedup_templates(spark):
    rows = [(1, "Order 17 was sent on 2020-01-02 to you\nmy own words are here"), (2, "Order 99 was sent on 2021-05-06 to you\nother words stand here"),
            (3, "please log in as alice to see this whole page\nunique third text"), (4, "please log in as bob to see this whole page\nunique fourth text"),
            (5, "please log in as carol to see this whole page"), (6, "ok\nok ok"), (7, "ok\nok ok")]
    got = {r["doc_id"]: r["text"] for r in lines.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "other words stand here", 3: rows[2][1], 4: "unique fourth text", 5: "", 6: "ok\nok ok", 7: "ok\nok ok"}


def test_line_dedup_without_blanks_or_constants(spark):
    """A long line without blanks recurs as it stands; lines of numbers alone recur only with the same numbers."""
    passage = "同じ文章がここにある。" * 4
    rows = [(1, f"{passage}\n12 7 3\n短い"), (2, f"{passage}\n12 7 4\n短い"), (3, "12 7 3\nmy own words here")]
    got = {r["doc_id"]: r["text"] for r in lines.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "12 7 4\n短い", 3: "my own words here"}


def test_lines_are_cut_once(spark, monkeypatch):
    plans, write = {}, lines.written
    monkeypatch.setattr(lines, "written", lambda df, name, **o: (plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}), write(df, name, **o))[1])
    rows = [(i, f"alpha\t\tbeta \rgamma\x0c{i} same tail words\none two three {i} four five\nalone {chr(97 + i)} stands here\n12 7 {i}\nab") for i in range(4)]
    docs = spark.createDataFrame(rows + [(None, None), (9, ""), (3, rows[3][1])], "doc_id long, text string")
    got = sorted((tuple(r) for r in lines.drop_recurring_lines(docs).collect()), key=str)
    late = [(i, f"alone {chr(97 + i)} stands here\n12 7 {i}\nab", 2, 5) for i in range(1, 4)]
    assert got == sorted([(0, rows[0][1], 0, 5), *late, late[-1], (None, None, 0, 0), (9, "", 0, 1)], key=str)
    # no filter cuts the lines a second time, no position of a line splits it again
    assert plans["line-signatures"].count("posexplode(") == 1 and "array_remove" not in "".join(x for x in plans["line-signatures"].splitlines() if "Filter" in x)
    assert "regexp_replace" not in "".join(x for x in plans["line-signatures"].splitlines() if "Filter" in x) and "size(split(" not in plans["line-positions"].split("Generate")[0]
    # found in all but one of four documents, counted once each
    some = spark.createDataFrame([(i, f"only {'x' * (i // 3)} words here") for i in (0, 1, 2, 2, 3)], "doc_id long, text string")
    assert [sum(r["n_dropped"] for r in lines.drop_recurring_lines(some, min_docs=n).collect()) for n in (2, 3, 4)] == [3, 3, 0]


def test_line_dedup_odd_rows(odd, empty):
    got = lines.drop_recurring_lines(odd)
    rows = got.collect()
    assert len(rows) == odd.count() and set(got.columns) == {*odd.columns, "n_lines"}
    by = {r["doc_id"]: r["text"] for r in rows}
    assert by[0] is None and by[1] == "" and by[9].startswith("same line") and by[10] == "third one" and by[6] and by[7] == ""
    assert len({(r["doc_id"], r["text"], r["n_dropped"]) for r in rows}) == len({r["doc_id"] for r in rows})
    assert lines.drop_recurring_lines(empty).count() == 0


# 2: toxicity

def test_automaton_is_edit_distance():
    terms = {"stupid": 3.0, "worthless": 4.0, "scum": 2.0, "vequ*": 2.5, "stupor": 1.0}
    auto = toxicity.Automaton(terms)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
        return row[-1]
    rng = np.random.default_rng(5)
    words = ["stupid", "stuppid", "stpid", "stupd", "worthles", "wortles", "wrthles", "wrthls", "scum", "scumm", "vequxyz", "vequ", "stupir", "", "x"]
    for w in list(words):
        for _ in range(40):
            c = list(w)
            for _ in range(rng.integers(0, 4)):
                k = int(rng.integers(0, len(c) + 1))
                c[k:k + int(rng.integers(0, 2))] = list("stupidwor"[int(rng.integers(0, 9))])[:int(rng.integers(0, 2))]
            words.append("".join(c))
    for w in words:
        near = [distance(w, t) for t in terms if not t.endswith("*") and distance(w, t) <= toxicity.edits_of(t)]
        got = auto.match(w)
        if near and min(near) == 0:
            assert got == (w, 0)
        elif w.startswith("vequ"):
            assert got == ("vequ*", 0)
        else:
            assert (got and got[1]) == (min(near) if near else None), w


def test_quotation_windows():
    words = 'he said the word idiot and left'.split()
    assert toxicity.quoted(words, 4) and not toxicity.quoted("you are an idiot and left".split(), 3)
    assert toxicity.quoted('they wrote "you idiot scum" on it'.split(), 3) and not toxicity.quoted('"fine" then you idiot go'.split(), 3)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in queries.op2_toxicity(spark, sf).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == 10_000 and all(r["held_out"] == (fold_of(i, 5) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for i, r in got.items())
    held = [(labels[i], r["score"]) for i, r in got.items() if r["held_out"] and i in labels]
    pos, neg = [s for y, s in held if y], [s for y, s in held if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.93, auc


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, None), (5, 1), (None, 1), (9, 0)], "doc_id long, toxic int")
    assert toxicity.classify(odd, labels).count() == odd.count()
    assert toxicity.classify(empty, labels).count() == 0
    assert all(r["score"] < 1e-6 for r in toxicity.classify(odd, labels.limit(0)).collect())


# 3: SimHash

def direct_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def direct_groups(fps, radius=3):
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_simhash_equals_direct(spark, docs):
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = {r["doc_id"]: r for r in queries.op3_simhash(spark, SF).collect()}
    fps = [direct_simhash(t) for _, t in rows]
    assert [got[i]["fingerprint"] for i, _ in rows] == [f"{f:016x}" for f in fps]
    assert [got[i]["component_id"] for i, _ in rows] == [rows[g][0] for g in direct_groups(fps)]


def test_links_with_split_cells(spark):
    """One cell holds nearly all fingerprints and is cut into shards; chains keep whole."""
    rng = np.random.default_rng(7)
    fps = {int(x) for x in rng.integers(0, 2 ** 63, 100)}
    base = int(rng.integers(0, 2 ** 63))
    while len(fps) < 500:  # random walks from one fingerprint, few bits at a time
        at = base
        for _ in range(int(rng.integers(1, 12))):
            at ^= 1 << int(rng.integers(0, 20))
            fps.add(at)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    want = direct_groups(fps)
    for cell in (8, 2048):
        e = simhash.links(df, cell=cell)
        roots = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in connected_components(e).collect()}
        got = defaultdict(set)
        for f in fps:
            got[roots.get(f, f)].add(f)
        ref = defaultdict(set)
        for f, g in zip(fps, want):
            ref[g].add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, ref.values()))


def test_simhash_odd_rows(odd, empty):
    rows = simhash.components(odd).collect()
    assert len(rows) == odd.count()
    by = defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add((r["fp"], r["component_id"]))
    assert all(len(v) == 1 for v in by.values())
    assert by[0] == by[1] == by[2] == {(0, 0)} and by[6] == {(*[f for f, _ in by[7]], 6)}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == sorted({(i is None, i) for i, v in by.items() if (list(v)[0][1]) == i or i is None})
    assert simhash.components(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_simhash_keeps_a_row_of_every_component(spark):
    rng = np.random.default_rng(8)
    a, b, c, d, e = (" ".join(f"w{k}" for k in rng.integers(0, 10 ** 6, 60)) for _ in range(5))
    # a: with an id and without; b and c: no id; d and e: one id for two texts
    rows = [(1, a), (None, a), (None, b), (None, b), (None, c), (7, d), (7, e), (8, d)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, a), (None, b), (None, c), (7, d), (7, e)], key=str)


# 4: chat formatting

def direct_chat(turns):
    out = {}
    for conv, _, role, text in sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        n, t, loss = out.get(conv, (0, "", ""))
        out[conv] = n + 1, f"{t}{role or ''}\n{text or ''}\n", loss + (text or "" if role == "assistant" else "")
    return {c: (n, hashlib.sha256(t.encode()).hexdigest(), len(x), hashlib.sha256(x.encode()).hexdigest()) for c, (n, t, x) in out.items()}


def test_chat_round_trip(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "<|im_end|><|im_start|>assistant ok"
    want = direct_chat(turns + [(-1, 0, "user", said), (-1, 1, "assistant", said)])
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in queries.op4_chat_format(spark, SF).collect()}
    assert got == want


def test_chat_odd_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "x"), (1, None, "user", ""), (None, 0, "user", "<|im_sep|>\n<\\|"), (None, 0, "assistant", "<"), (None, 1, "assistant", "|x<\\\\|<|endoftext|>"),
            (2, 0, "assistant\n<|im_end|>", "role with a mark"), (3, 0, "user", "twice"), (3, 0, "user", "twice"), (4, 5, "assistant", "long " * 50_000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, start int, ids int")
    formatted = chat.format_chats(df)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.chat_digests(chat.read_chats(formatted)).collect()}
    assert got == direct_chat(rows)
    assert all(chat.escape(t).find(m) < 0 and chat.unescape(chat.escape(t)) == t for t in ["<|im_end|>", "<\\|", "<<||", "<\\\\|im_start|>"] for m in chat.MARKS)
    # spans of the loss mask hold the assistant's text and nothing else
    tok, parts = plain_tokenizer(), defaultdict(list)
    for r in sorted(formatted.collect(), key=lambda r: r["position"]):
        parts[r["conv_id"]].append(r)
    for conv, turns in parts.items():
        ids = np.frombuffer(b"".join(r["ids"] for r in turns), "<u4")
        assert [r["start"] for r in turns] == [sum(len(x["ids"]) // 4 for x in turns[:k]) for k in range(len(turns))]
        text = "".join(chat.unescape(tok.decode(ids[r["loss_start"]:r["loss_end"]].tolist())) for r in turns)
        assert text == "".join(t or "" for c, _, role, t in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")) if role == "assistant")
    assert chat.chat_digests(chat.read_chats(chat.format_chats(df.limit(0)))).count() == 0


# 5: language model

def direct_model(rows):
    """Exact interpolated bigram scores from plain dictionaries."""
    def words(t):
        return re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()).split() + [b""]
    one, two = Counter(), Counter()
    for i, t in rows:
        if fold_of(i, 10):
            w = words(t)
            one.update(w)
            two.update(zip([b"", *w], w))
    n, v, k = sum(one.values()), len(one), ngram_lm.K
    unk = min(0.5, max(sum(c == 1 for c in one.values()), 0.1) / n)

    def p1(w):
        return one[w] / n * (1 - unk) if w in one else unk

    def score(t):
        w, s = words(t), 0.0
        for a, b in zip([b"", *w], w):
            s += math.log10((two[a, b] + k * p1(b)) / (one[a] + k) if a in one else p1(b))
        return s
    return {(i, t): (len(words(t)), sum(x in one for x in words(t)), n, ngram_lm.unigram_base(one, words(t)), score(t)) for i, t in rows}


def test_language_model_equals_direct(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {i: v for (i, _), v in direct_model(rows).items()}
    got = {r["doc_id"]: r for r in queries.op5_ngram_lm(spark, SF).collect()}
    assert got.keys() == want.keys()
    for i, (n, known, total, base, own) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, fold_of(i, 10) == 0)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(own, abs=n / 32 + 1e-6)  # probabilities have 8 bits
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = direct_model(rows)
    got = ngram_lm.held_out_scores(odd).collect()
    assert len(got) == len(rows)
    by = {i: v for (i, _), v in want.items()}
    for r in got:
        n, known, total, base, own = by[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) and r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(own, abs=n / 32 + 1e-6)
    assert ngram_lm.held_out_scores(empty).count() == 0
    assert {r["score"] for r in ngram_lm.held_out_scores(odd.where("doc_id is null")).collect()} == {0.0}


@pytest.mark.parametrize("order", [2, 3, 4])
def test_language_model_of_longer_contexts(spark, docs, order):
    rows = [(r["doc_id"], (r["text"] or "")[:1500]) for r in docs.limit(60).collect()] + [(1000, "a b c d a b c e"), (1001, "a b c d x b c d"), (1002, ""), (None, "a b c d")]

    def words(t):
        return [b""] + re.sub(rb"[A-Z]", lambda m: m[0].lower(), t.encode()).split() + [b""]
    grams = Counter(tuple(w[j - n:j]) for i, t in rows if fold_of(i, 10) for w in [words(t)] for n in range(2, order + 1) for j in range(n, len(w) + 1))
    one = Counter(x for i, t in rows if fold_of(i, 10) for x in words(t)[1:])
    total, k = sum(one.values()), ngram_lm.K
    unk = min(0.5, sum(c == 1 for c in one.values()) / total)

    def direct(t):
        w, s = words(t), 0.0
        for j in range(1, len(w)):
            p = one[w[j]] / total * (1 - unk) if w[j] in one else unk
            for n in range(2, min(order, j + 1) + 1):
                seen = one[w[j - 1]] if n == 2 else grams[tuple(w[j - n + 1:j])]
                p = (grams[tuple(w[j - n + 1:j + 1])] + k * p) / (seen + k) if seen else p
            s += math.log10(p)
        return s
    got = ngram_lm.held_out_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), order=order).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for i, t in rows:
        assert by[i]["order_score"] == pytest.approx(direct(t), abs=by[i]["n_tokens"] / 32 + 1e-6)
    if order == 2:
        assert all(r["order_score"] == pytest.approx(r["score"]) for r in got)
    else:
        assert sum(r["order_score"] for r in got if r["doc_id"] and fold_of(r["doc_id"], 10)) > sum(r["score"] for r in got if r["doc_id"] and fold_of(r["doc_id"], 10))


# 6: SpotSigs

def direct_signatures(text):
    words = [w for w in re.split(r"[^\w]+|_+", (text or "").lower()) if w]
    run, chunks = [], []
    for w in words:
        if w in spotsigs.ANCHORS:
            run.append(w)
        else:
            chunks.append((run, w))
            run = []
    out = {(a, w, chunks[j + 1][1]) for j, (run, w) in enumerate(chunks[:-1]) for a in run}
    return out or {tuple(words)}


def test_spotsigs_equals_direct(spark, docs):
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    got = {r["doc_id"]: r for r in queries.op6_spotsigs(spark, SF).collect()}
    assert len(got) == len(rows)

    def like(a, b):
        return len(a & b) / len(a | b)
    prints = {}
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        edited = t[:len(t) - q] + nxt[:q]
        r, s = got[i], direct_signatures(t)
        assert (r["n_chars"], r["edited_sha256"], r["n_signatures"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), len(s))
        assert r["near_edited"] == pytest.approx(like(s, direct_signatures(edited))) and r["near_next"] == pytest.approx(like(s, direct_signatures(nxt)))
        assert prints.setdefault(frozenset(s), r["fingerprint"]) == r["fingerprint"]
    assert len(set(prints.values())) == len(prints)


def test_spotsigs_pairs(docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    sets = {i: direct_signatures(t) for i, t in rows}
    want = {frozenset((a, b)) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    links, members = spotsigs.similar_pairs(docs)
    of, got = defaultdict(set), set()
    for r in members.collect():
        of[r["fp"]].add(r["doc_id"])
    for m in of.values():
        got |= {frozenset((a, b)) for a in m for b in m if a < b}
    for r in links.collect():
        got |= {frozenset((a, b)) for a in of[r["fp_a"]] for b in of[r["fp_b"]]}
    assert got == want and want


def test_spotsigs_odd_rows(odd, empty):
    got = spotsigs.fingerprint_edits(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r["fingerprint"] for r in got}
    assert by[0] == by[1] and by[6] == by[7] and by[6] != by[1]
    assert [r["near_next"] for r in got if r["doc_id"] == 6] == [1.0]
    assert spotsigs.fingerprint_edits(empty).count() == 0
    one = spotsigs.fingerprint_edits(odd.where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


# 7: packing

def check_pieces(pieces, rows, window=2048):
    plain = plain_tokenizer()
    want = Counter()
    for i, t in rows:
        want[i, u32(plain.encode(t or "", add_special_tokens=False).ids + [1])] += 1
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
        assert p["length"] > 0
    for s, parts in seqs.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == window or s == max(seqs) and at < window
    assert sorted(seqs) == list(range(len(seqs)))
    stream = [(p["sequence_id"] * window + p["offset"], p) for p in pieces]
    got, now = Counter(), b""
    for _, p in sorted(stream, key=lambda x: x[0]):
        assert p["start"] * 4 == len(now)
        now += p["ids"]
        if len(now) == 4 * p["doc_tokens"]:
            got[p["doc_id"], now] += 1
            now = b""
    assert got == want


def test_packing(spark, docs, odd, empty):
    check_pieces(packing.pack(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    pieces = packing.pack(odd)
    check_pieces(pieces.collect(), [(r["doc_id"], r["text"]) for r in odd.collect()])
    whole = packing.sequences(pieces).collect()
    assert all(len(r["ids"]) == 4 * (2048 if r["n_tokens"].bit_count() != 1 else r["n_tokens"]) for r in whole) and sum(r["n_tokens"] for r in whole) == sum(p["length"] for p in pieces.collect())
    assert packing.pack(empty).count() == 0
    got = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in queries.op7_packing(spark, SF).collect()}
    assert all(got[p["doc_id"], p["start"]] == zlib.crc32(p["ids"]) for p in packing.pack(docs).collect())


# 8: language ID

def test_forward_backward_is_exact():
    rng = np.random.default_rng(2)
    scores, trans, first = rng.normal(size=(4, 1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    paths = np.array(np.meshgrid(*[range(3)] * 4)).reshape(4, -1).T
    weight = np.array([np.exp(first[p[0]] + sum(scores[t, 0, p[t]] for t in range(4)) + sum(trans[p[t], p[t + 1]] for t in range(3))) for p in paths])
    got, expected, log = langid.forward_backward(scores, np.array([4]), trans, first, pairs=True)
    for t in range(4):
        for k in range(3):
            assert got[t, 0, k] == pytest.approx(weight[paths[:, t] == k].sum() / weight.sum())
    assert log == pytest.approx(np.log(weight.sum()))
    assert expected[1, 2] == pytest.approx(sum(weight[(paths[:, t] == 1) & (paths[:, t + 1] == 2)].sum() for t in range(3)) / weight.sum())


def test_language_held_out_and_switches(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lang = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    got = {r["doc_id"]: r for r in queries.op8_language_id(spark, sf).collect()}
    held = [(lang[i], r) for i, r in got.items() if r["held_out"]]
    assert len(got) == 1000 and np.mean([r["lang_pred"] == want for (want, _), r in held]) > 0.93
    model = langid.train(docs)
    (lines_, m), = model.word_marginals(["the and that thing inthe with of ther der und die keit lich ein schung nicht"])
    assert [model.langs[k] for k in m.argmax(axis=1)[:6]] == ["en"] * 6 and [model.langs[k] for k in m.argmax(axis=1)[-6:]] == ["de"] * 6


def test_language_odd_rows(odd, empty):
    rows = {r["doc_id"]: r for r in langid.identify(odd).collect()}
    assert langid.identify(odd).count() == odd.count()
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (0, 1, 2, 3)) and rows[4]["lang_pred"] == "en"
    kept = langid.keep_identified(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {None, 4, 5, 6, 7, 8, 9, 10, 11}
    assert langid.identify(empty).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd.withColumn("lang", odd["source"])).collect()} == {"und"}


def test_language_of_every_label(spark):
    # 66 languages with words of their own; the last has the fewest rows
    own = [[f"{chr(97 + k % 26)}{chr(97 + k // 26)}{x}" for x in ("qo", "zu", "ixa", "emm")] for k in range(66)]
    rows = [(100 * k + i, " ".join(words), f"l{k:02d}") for k, words in enumerate(own) for i in range(5 if k < 65 else 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert len(model.langs) == 66 and model.languages([" ".join(own[65])])[0][0] == "l65"


def test_language_keeps_mixed_and_unlabelled_text(spark):
    words = {"en": "the and that thing with of there", "de": "der und keit schung nicht ein lich", "fr": "les des eau ment que oui mais"}
    rows = [(k * 100 + i, f"{t} {t}", lang) for k, (lang, t) in enumerate(words.items()) for i in range(12)]
    rows += [(999, "\n".join(words.values()), None), (1000, "12 34", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    (_, score, sure), = langid.train(docs).languages([rows[-2][1]])
    assert score < 0.5 < sure
    want = {r[0] for r in rows} - {1000}
    assert {r["doc_id"] for r in langid.keep_identified(docs).collect()} == want
    assert {r["doc_id"] for r in langid.keep_identified(docs.withColumn("lang", docs["lang"].substr(9, 2)).selectExpr("doc_id", "text", "nullif(lang, '') as lang")).collect()} == want


# 9: token files

def test_token_files(spark, docs, odd, empty):
    plain = plain_tokenizer()
    for df in (docs, odd):
        rows = sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
        got = sorted(token_files.token_files(df, segment_ids=1000).collect(), key=lambda r: r["start"])
        at = 0
        assert [r["doc_id"] for r in got] == [i for i, _ in rows]
        for r, (_, t) in zip(got, rows):
            want = u32(plain.encode(t or "", add_special_tokens=False).ids + [2])
            assert (r["start"], r["n_tokens"], bytes(r["ids"])) == (at, len(want) // 4, want)
            at += len(want) // 4
    assert token_files.token_files(empty).count() == 0
    seg = token_files.Segment(token_files.pack_segment([None, -5, -5, 7], [u32([2]), u32([1, 2]), u32([70000, 2]), u32([2])], 4))
    assert seg.doc_ids() == [None, -5, -5, 7] and [seg.span(i) for i in range(4)] == [(0, 1), (1, 3), (3, 5), (5, 6)] and seg.ids.tolist() == [2, 1, 2, 70000, 2, 2]


def test_ngram_keys_beyond_63_bits_raise():
    one = np.array([3], "i8")
    assert ngram_lm.joined(np.array([2 ** 40], "i8"), one, 2 ** 22).tolist() == [2 ** 62 + 3] and len(ngram_lm.joined(one[:0], one[:0], 2 ** 40)) == 0
    with pytest.raises(OverflowError):
        ngram_lm.joined(np.array([2 ** 40], "i8"), one, 2 ** 24)


# 10: decontamination

@pytest.mark.parametrize("options", [{}, {"shard_words": 500, "block_words": 4000}])
def test_decontamination_equals_direct(spark, docs, options):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(str(r["item_id"]), r["text"]) for r in bench.collect()]
    windows = {}
    for name, t in items:
        w = decontaminate.words_of(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(name)
    got = {r["doc_id"]: r for r in decontaminate.find_leaks(docs, bench, **options).collect()}
    leaks = 0
    for r in docs.collect():
        words = decontaminate.words_of(r["text"])
        hit, names = set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if n := windows.get(tuple(words[k:k + size])):
                    hit |= set(range(k, k + size))
                    names |= n
        g = got[r["doc_id"]]
        assert g["n_words"] == len(words) and {k for s in g["spans"] for k in range(s["start"], s["end"])} == hit and set(g["items"]) == names
        leaks += bool(hit)
    assert leaks >= 3


def test_decontamination_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, "Same line, here ONCE!", 0), (2, None, 0), (3, "", 0), (4, "the of", 0), (None, "no id at all", 0), (4, "house3", 0), (5, "naïve", 0), (6, "A", 0)], "item_id long, text string, spans int")
    items = [("" if r["item_id"] is None else str(r["item_id"]), r["text"]) for r in bench.collect()]
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    short = odd.where("doc_id is null or doc_id not in (6, 7)")
    rows = decontaminate.find_leaks(short, bench, shard_words=5).collect()
    assert len(rows) == short.count()
    for r in rows:
        n, hit, k, digest = decontaminate.brute_force(texts[r["doc_id"]], items)
        assert (r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["items"])) == (n, hit, k)
        assert hashlib.sha256(",".join(sorted(r["items"])).encode()).hexdigest() == digest
    cleaned = decontaminate.clean(odd, bench)
    by = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert cleaned.columns == odd.columns and by[0] is None and by[9].strip() == "second different line" and by[4] == "" and "house3 " not in by[6] and "house4" in by[6]
    assert decontaminate.find_leaks(empty, bench).count() == 0 and decontaminate.find_leaks(odd, bench.limit(0)).where("size(spans) > 0").count() == 0


def test_decontamination_block_by_block(spark):
    """A window of many items lies in several blocks, and the plan has one Python step whatever the number of blocks."""
    bench = spark.createDataFrame([(k, "one two three") for k in range(30)] + [(99, "four five")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x one two three four five"), (2, "One, two; THREE"), (3, "two three"), (None, None)], "doc_id long, text string")
    whole, blocks = decontaminate.find_leaks(docs, bench), decontaminate.find_leaks(docs, bench, block_words=16)
    for got in (whole, blocks):
        rows = {r["doc_id"]: (r["n_words"], [tuple(s) for s in r["spans"]], sorted(map(int, r["items"]))) for r in got.collect()}
        assert rows == {1: (6, [(1, 6)], [*range(30), 99]), 2: (3, [(0, 3)], [*range(30)]), 3: (2, [], []), None: (0, [], [])}
        assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert decontaminate.clean(docs, bench, block_words=16).columns == docs.columns


def test_fm_index_on_repeats():
    rng = np.random.default_rng(4)
    runs = [rng.integers(1, 4, int(n)) for n in rng.integers(1, 40, 60)]
    seq = np.concatenate([np.append(r, 0) for r in runs])
    index = decontaminate.FMIndex(seq, 4)
    patterns = np.zeros((200, 5), "i8")
    for p in patterns:
        n = int(rng.integers(1, 6))
        p[5 - n:] = rng.integers(1, 4, n)
    lo, hi = index.search(patterns)
    for p, a, z in zip(patterns, lo, hi):
        w = p[p > 0]
        want = [k for k in range(len(seq) - len(w) + 1) if (seq[k:k + len(w)] == w).all()]
        assert sorted(index.locate(np.arange(a, max(a, z))).tolist()) == want


def test_word_hashes():
    """Every separator, words around the step and block lengths, and many words with one high part."""
    import re
    data = ("Abc abc  ABC x\x0b\n\x1c " + " ".join("q" * n for n in (7, 8, 9, 16, 63, 64, 65, 200)) + " " + "Q" * 200 + " é日本 abcdefgh abcdefghi").encode()
    starts, h = ngram_lm.word_hashes(data)
    want = [(m.start(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", data.lower())]
    assert starts.tolist() == [at for at, _ in want]
    assert len(set(h.tolist())) == len({w for _, w in want}) == len(set(zip(h.tolist(), (w for _, w in want))))
    assert all(len(x) == 0 for text in (b"", b" \n") for x in ngram_lm.word_hashes(text))
    dense = EliasFano(EliasFano.encode(np.append(np.arange(0, 9000, 3), 1 << 40)))
    assert dense.find(np.arange(9000)).tolist() == [k // 3 if k % 3 == 0 else -1 for k in range(9000)]
