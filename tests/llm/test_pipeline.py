"""The corpus pipeline from end to end: every stage against what its operator's contract says, on plain and on odd rows."""

import collections

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stockpulse.llm import simhash
from stockpulse.llm.tokens import default_tokenizer

SF = "/root/testdata/sf0.001"
ODD_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, fp long, n long, ids string, part int, root long, spans string"


def _odd(doc_id, text, lang=None):
    return Row(doc_id=doc_id, text=text, lang=lang, source=None, n_chars=None if text is None else len(text), fp=1, n=2, ids="x", part=0, root=5, spans=None)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The whole test tables, with odd rows: nulls, empty and long texts, copies, a repeated row, null ids, clashing columns."""
    at = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.where("lang is not null").orderBy("doc_id").first()
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [_odd(900_001, None), _odd(900_002, ""), _odd(900_003, " \n\t"), _odd(900_004, "1234 !!! 99"), _odd(900_005, first["text"], first["lang"]),
            _odd(900_005, first["text"], first["lang"]), _odd(None, first["text"] + " one more word here"), _odd(None, None),
            _odd(900_006, f"{first['text']}\n{passage}", first["lang"]), _odd(900_007, " ".join([first["text"]] * 40), first["lang"])]
    wide = docs.selectExpr("doc_id", "text", "lang", "source", "cast(n_chars as long) n_chars", "1L fp", "2L n", "'x' ids", "0 part", "5L root", "cast(null as string) spans")
    wide.union(spark.createDataFrame(rows, ODD_COLUMNS)).repartition(4).write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{at}/benchmark.parquet")
    return at


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The table before the first stage and after each."""
    from stockpulse.llm.common import written
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], folder), f"test-{name}"))
    return out


def _rows(df):
    return collections.Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_columns_stay_until_packing(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
        assert df.where("text is not null and n_chars <> char_length(text)").count() == 0


def test_language_id_rejects_what_has_no_letters_and_keeps_prose(stages):
    before, after = _rows(stages[0]), _rows(stages[1])
    assert not after - before
    gone = before - after
    for key in [(900_001, None), (900_002, ""), (900_003, " \n\t"), (900_004, "1234 !!! 99"), (None, None)]:
        assert gone[key] == before[key]
    prose = {(r["doc_id"], r["text"]) for r in stages[0].where("lang is not null and char_length(text) > 200").collect()}
    assert sum(k in after for k in prose) >= 0.97 * len(prose)


def test_line_dedup_only_drops_lines(stages):
    before, after = (collections.defaultdict(list), collections.defaultdict(list))
    for to, df in ((before, stages[1]), (after, stages[2])):
        for r in df.select("doc_id", "text").collect():
            to[r["doc_id"]].append(r["text"])
    assert {k: len(v) for k, v in before.items()} == {k: len(v) for k, v in after.items()}
    for k, texts in after.items():
        lines = collections.Counter(x for t in before[k] for x in t.split("\n"))
        assert not collections.Counter(x for t in texts for x in t.split("\n") if x) - lines
    assert sum(map(len, (t for v in after.values() for t in v))) < sum(map(len, (t for v in before.values() for t in v)))


def test_near_dedup_keeps_one_of_each_group(spark, stages):
    before, after = _rows(stages[2]), _rows(stages[3])
    assert not after - before
    # every text that is left stands for one group, and every group has one
    texts = sorted({t for _, t in before})
    numbered = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in enumerate(texts)], "doc_id long, text string")
    group = {texts[r["doc_id"]]: r["component_id"] for r in simhash.components(numbered).select("doc_id", "component_id").collect()}
    assert collections.Counter(group[t] for _, t in after.elements()) == dict.fromkeys(group.values(), 1)


def test_decontamination_takes_out_benchmark_passages(spark, stages):
    import re
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i:i + 10]) for w in items if w for i in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    hit = lambda t: any(tuple(w[i:i + n]) in windows for w in [words(t)] for n in sizes for i in range(len(w) - n + 1))
    before, after = ({(r["doc_id"]): r["text"] for r in df.collect()} for df in (stages[3], stages[4]))
    assert any(map(hit, before.values()))
    assert stages[3].count() == stages[4].count()
    for k, t in before.items():
        if not hit(t):
            assert after[k] == t


def test_packing_covers_every_token_once(stages):
    pieces = stages[5].collect()
    docs = stages[4].count()
    by = collections.defaultdict(list)
    for r in pieces:
        by[r["sequence_id"]].append(r)
    for own in by.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == list(np.cumsum([0, *[r["length"] for r in own]])[:-1]) and sum(r["length"] for r in own) <= 2048
    assert sorted(by) == list(range(len(by)))
    whole = collections.defaultdict(int)
    for r in pieces:
        whole[r["doc_id"]] += r["length"]
    ends = sum(1 for r in pieces if r["start"] == 0)
    assert ends == docs and sum(whole.values()) == sum(r["doc_tokens"] for r in pieces if r["start"] == 0)
    # the ids of every document that is alone under its doc_id are those of the tokenizer
    texts = collections.defaultdict(list)
    for r in stages[4].select("doc_id", "text").collect():
        texts[r["doc_id"]].append(r["text"])
    tokenizer = Tokenizer.from_file(default_tokenizer())
    ids = collections.defaultdict(list)
    for r in sorted(pieces, key=lambda r: r["start"]):
        ids[r["doc_id"]].append(np.frombuffer(r["ids"], "<u4"))
    for k, own in texts.items():
        if len(own) == 1:
            assert np.concatenate(ids[k]).tolist() == [*tokenizer.encode(own[0] or "", add_special_tokens=False).ids, 1]


def test_run_equals_its_stages(spark, folder, stages):
    tokens = lambda df: collections.Counter((r["doc_id"], r["doc_tokens"]) for r in df.where("start = 0").collect())
    assert tokens(corpus_pipeline.run(spark, folder)) == tokens(stages[5])


def test_empty_tables(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
