import glob
import os
import re

import pytest

import plantwise.llm
import os


SF = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(30)]


def helper_names():
    """Every name that looks like a column in the subpackage's source."""
    found = {"host", "row", "text_", "a.b"}
    for path in glob.glob(os.path.join(os.path.dirname(plantwise.llm.__file__), "*.py")):
        with open(path) as f:
            found |= set(re.findall(r"[\"'](_{1,2}[a-z]\w*)[\"']", f.read()))
    return sorted(x for x in found if x not in ("__main__",))


@pytest.fixture()
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and
    extra columns whose names operators use themselves."""
    long = " ".join(f"word{i % 997} x{i}" for i in range(4000))
    same = " ".join(WORDS * 4)
    rows = [(1, same, "en", "a", 3), (2, same, "en", "a", 3), (2, same, "en", "a", 3), (3, None, None, None, None),
            (None, same + " tail", "en", None, 1), (None, None, None, "b", 0), (4, "", "fr", "b", 0), (5, " \n\t ", "fr", "b", 4),
            (6, long, "en", "c", 9), (7, long[: len(long) // 2] + " é ü 中文 " + long, "en", "c", 9), (8, "one", "de", "c", 3)]
    helpers = helper_names()
    df = spark.createDataFrame([(*r, *["k"] * len(helpers)) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{h}` string" for h in helpers))
    return df.repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
