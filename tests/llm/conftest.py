import random

import pytest

SF = "/root/testdata/sf0.001"
# names that operators use inside; they must not get in the way
CLASHES = ("n_words", "ledger", "mark", "text_hash", "line", "cuts", "members", "vertex", "topic", "mixed", "judged", "host")


def words(rng, n):
    return " ".join(rng.choice(("alpha", "beta", "gamma", "delta", "of", "the", "Zeta", "é", "中文", "x9")) for _ in range(n))


def odd_texts():
    rng = random.Random(5)
    long = words(rng, 30_000)
    passage = words(rng, 120)
    near = words(rng, 200).split(" ")
    other = [*near[:100], "changed", *near[101:]]
    return [
        None, "", " \t\n ", "one", "two words", "A b\nA b\nA b\nc", passage, passage, passage + " tail of its own",
        "head " + passage, long, long, " ".join(near), " ".join(other), "\u2003odd\u00a0space\x85", "tab\x0bx\x0cy",
        "token = \"0123456789abcdef0123456789abcdef\"", "cc by and All Rights Reserved.\nSPDX-License-Identifier: MIT OR (GPL-2.0 AND x)",
        "shared line that stands everywhere\n" + words(rng, 60), "shared line that stands everywhere\n" + words(rng, 70),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, long and repeated texts, repeated rows and clashing column names."""
    rows = [(i, t, f"s{i % 4}", "en", None) for i, t in enumerate(odd_texts())]
    rows += [rows[6], rows[6], (None, "no id here", None, None, 3), (3, "one", "s1", None, None)]
    extra = ", ".join(f"{c} string" for c in CLASHES)
    filled = [(*r, *["kept"] * len(CLASHES)) for r in rows]
    return spark.createDataFrame(
        filled, f"doc_id long, text string, source string, lang string, n_chars long, {extra}").cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
