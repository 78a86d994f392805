"""Memory and work of a Python worker that encodes texts or tells their language."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stockpulse.llm import langid, packing, tokens
from stockpulse.llm.common import BATCH_BYTES
from stockpulse.llm.tokens import Encoder, default_tokenizer


def _peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _direct(enc, texts):
    return [np.array(enc.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_known_words_are_looked_up_outside_python():
    enc = Encoder(default_tokenizer())
    text = " ".join(f"word{k} is{k}." for k in range(20_000))
    first = enc.encode([text])
    assert first == _direct(enc, [text])
    assert _peak(lambda: enc.encode([text])) < 60 * 40_000  # an object for each word is more
    assert enc.encode([text]) == first


def test_word_cache_keeps_what_was_used_last(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 100)
    enc, asked = Encoder(default_tokenizer()), []
    learn = enc._learn
    monkeypatch.setattr(enc, "_learn", lambda parts, cache, lead: (asked.extend(lead + w for w in parts), learn(parts, cache, lead)))
    often = "x always here. always"
    for k in range(12):
        texts = [often, " ".join(f"q{k}z{i}" for i in range(40))]
        assert enc.encode(texts) == _direct(enc, texts)
        assert len(enc.words) <= 150
    assert asked.count(" always") == 1 and asked.count(" here") == 1


def test_texts_reach_workers_in_bounded_batches(spark):
    text = "some words of a text " * 2_000
    docs = spark.range(0, 1000, 1, 1).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"), F.lit("en").alias("lang"), F.lit("").alias("source"))
    assert packing.pack(docs.limit(2)).count()

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    got = docs.select("text").mapInArrow(sizes, "n long").agg(F.max("n"), F.sum("n")).first()
    assert got[1] >= 1000 * len(text) and got[0] <= BATCH_BYTES + 2 * len(text)


def test_new_words_are_learned_in_bounded_memory():
    model = langid.fit([("the house and the garden of the man", "en"), ("la maison et le jardin de la dame", "fr")] * 5)
    rng = np.random.default_rng(3)
    words = {"".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (60_000, 9))}
    whole = langid.Model(*model.__getstate__())
    assert _peak(lambda: model._learn(words)) < 80_000_000
    some = sorted(words)[:500]
    whole._learn(set(some))
    assert np.array_equal(np.stack([model.table[model.cache[w]] for w in some]), np.stack([whole.table[whole.cache[w]] for w in some]))
