import random

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from conftest_llm import prose  # noqa: E402

#: Beside the columns of documents, names that operators give to their results
#: or might give to helpers.
CLASHES = "size target node taken __file __row _metadata tilt __s __b __start __bucket __key __pass given passes id rid runs".split()
KIND = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def rows(texts, first=0):
    return [(first + k, t, ["en", None, "de"][k % 3], ["b", "a", None, "c"][k % 4], len(t or ""), *("x" for _ in CLASHES)) for k, t in enumerate(texts)]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and very long texts, copies, repeated rows, repeated and
    null ids, clashing column names."""
    rng = random.Random(7)
    base = [prose(rng, 80) for _ in range(6)]
    near = [" ".join(w if k != 40 else "zzz" for k, w in enumerate(t.split())) for t in base[:3]]
    texts = [None, "", "   ", "one", "one two three", "One Two three", *base, base[0], base[0], *near, base[1] + " " + base[2],
             prose(rng, 30_000), "tab\tand\nnewline\x0b end", "é ü ñ ß é ü ñ ß", None]
    data = rows(texts)
    data += [data[6], data[6], (None, base[3], None, None, None, *(None for _ in CLASHES)), (3, prose(rng, 12), "en", "a", 1, *(None for _ in CLASHES))]
    return spark.createDataFrame(data, KIND).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="session")
def make(spark):
    def frame(texts, first=0):
        return spark.createDataFrame(rows(texts, first), KIND).repartition(2)
    return frame
