import random

import pytest

#: Extra columns whose names clash with those the operators use inside and return.
EXTRA = ["text_sha256", "n_bytes", "fp", "h1", "u1", "key", "score", "chunk", "gone", "_score", "shard"]


def sentence(rng, n, letters="abcdeé"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(n))


def corpus():
    """(doc_id, text) with nulls, empties, copies, near copies, ties, long texts and repeated rows."""
    rng = random.Random(5)
    base = [sentence(rng, 60) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[0]) for i in range(20)] + [(130, base[0].replace(" ", "\n")), (131, base[0] + "  \t")]
    for i in range(25):
        words = base[1].split()
        words[rng.randrange(len(words))] = "x" * rng.randint(1, 3)
        rows.append((200 + i, " ".join(words)))
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "one"), (304, "a\x00b   ß"), (None, base[2]), (None, None), (305, sentence(rng, 4000))]
    rows += [(3, base[3])] * 3 + [(306, base[4] + "\n" + base[5] + "\n" + base[4]), (307, base[5][:-1] + "q\n" + base[6][1:])]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, id_col="doc_id", text_col="text"):
        schema = f"{id_col} long, {text_col} string, " + ", ".join(f"{c} string" for c in EXTRA)
        return spark.createDataFrame([(i, t, *("clash",) * len(EXTRA)) for i, t in rows], schema).repartition(3)

    return make
