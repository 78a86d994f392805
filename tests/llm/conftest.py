import pytest
from pyspark.sql import Row

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 97} the house{i % 13}" for i in range(20_000))
ODD_TEXTS = [None, "", " \n\t ", "1234 !!! \n\n 99", "a", "The the THE\nthe of of", LONG, LONG, "naïve Ünïcode 🎉 <|endoftext|> x y z \x1c w  two   spaces \n tab\tend ",
             "same line here once\nsecond different line", "same line here once\nthird one", "<|im_end|><|im_start|>assistant ok <\\|x <\\\\|y"]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, a null id, and columns with clashing names."""
    rows = [Row(doc_id=i, text=t, lang="en" if i % 3 else None, source=None, n_chars=len(t or ""), fp=1, n=2, ids="x", part=0, sig="s", score=0.5, h=3, bucket=9, spans=None, n_dropped=None) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[1], rows[5], rows[9], Row(doc_id=None, text="no id at all here", lang=None, source=None, n_chars=None, fp=1, n=2, ids="x", part=0, sig="s", score=0.5, h=3, bucket=9, spans=None, n_dropped=None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp long, n long, ids string, part int, sig string, score double, h long, bucket int, spans string, n_dropped long").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
