import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, t string, key string, h string, n long, rep long, "
          "part int, dest int, score double, a long, v string, k string, __x long")


def rows_with_extras(pairs, lang="en"):
    """Rows of ``documents`` with further columns that bear the operators' own names."""
    return [(i, t, lang, "src", None if t is None else len(t), "x", "x", "x", 1, 2, 3, 4, 0.5, 6, "v", "k", 9) for i, t in pairs]


@pytest.fixture(scope="session")
def edge_pairs():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    long = " ".join(word() for _ in range(30_000))
    passage = " ".join(word() for _ in range(60))
    prose = [" ".join(word() for _ in range(rng.randint(1, 120))) for _ in range(30)]
    pairs = [(k, t) for k, t in enumerate(prose)]
    pairs += [(100, None), (101, ""), (102, " \t\n "), (103, "one"), (104, "ONE"), (105, long), (106, long + " tail"), (107, passage),
              (108, prose[3] + " " + passage), (109, passage + "\n" + prose[4]), (110, "x" * 50_000), (None, prose[5]), (None, None),
              (111, "same text"), (111, "same text"), (112, "same  text"), (113, prose[6] + " " + prose[7]), (113, prose[8]),
              (114, "mail a.b@c.de or +1 (555) 123-4567, 10.0.0.300, 10.0.0.3 card 4111 1111 1111 1111"), (115, "ΣΑΣ İ é <|endoftext|> don't"),
              (-7, prose[9]), (1 << 40, prose[9])]
    return pairs


@pytest.fixture(scope="session")
def edge_docs(spark, edge_pairs):
    return spark.createDataFrame(rows_with_extras(edge_pairs), SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
