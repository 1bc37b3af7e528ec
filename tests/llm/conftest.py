import random

import pytest

CLASHING = ["id", "row", "size", "rank", "score", "fp", "component_id", "target", "h", "key", "text_", "lang_found", "starts", "root"]


def write(spark, tmp, rows, schema, name="t"):
    """A stored table with extra columns whose names the operators use inside."""
    extra = [c for c in CLASHING if c not in schema.replace(",", " ").split()]
    df = spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], schema + "".join(f", {c} string" for c in extra))
    df.repartition(3).write.mode("overwrite").parquet(f"{tmp}/{name}.parquet")
    return spark.read.parquet(f"{tmp}/{name}.parquet")


def hard_documents(seed=3, n=60):
    """(doc_id, text, lang, source): copies, near copies, shared passages, null, empty, junk and very long texts."""
    r = random.Random(seed)
    words = {"en": ["the", "and", "of", "thing", "with", "house"], "de": ["der", "und", "nicht", "straße", "über", "haus"]}
    vocab = {k: v + [f"{r.choice(v)}{r.choice(v)}{i}" for i in range(60)] for k, v in words.items()}

    def text(lang, n):
        return " ".join(r.choice(vocab[lang]) + r.choice(["", "", ".", ",\n"]) for _ in range(n)).replace("\n ", "\n")

    passage = [text("en", 70) for _ in range(3)]
    rows = []
    for i in range(n):
        lang = r.choice(["en", "de"])
        t = text(lang, r.randint(1, 120))
        if i % 4 == 0:
            p, a = r.choice(passage), r.randint(0, 40)
            t = t + " " + p[a:] + " " + text(lang, 5)
        rows.append((i, t, lang, r.choice(["a", "b", "ä", None])))
    rows += [(100 + i, rows[4][1], "en", "b") for i in range(9)]
    rows += [(120, rows[6][1] + " more", "en", "a"), (121, None, "en", "a"), (122, "", None, None), (123, "   \n\t ", "de", "b"),
             (124, "12 34 !! 56", "en", "c"), (None, "the thing and the house", None, "c"), (None, None, None, None),
             (125, "x" * 700, "en", "c"), (126, "ab" * 400, "en", "c"), (127, "🎉 日本語 テキスト ▁ <|endoftext|> </s> a  b", "en", "c"),
             (128, text("de", 6000), "de", "long"), (129, "wort " * 300, "de", "c"), (7, rows[7][1], "en", "a"), (7, rows[7][1], "en", "a")]
    return rows


DOC_SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("docs"), hard_documents(), DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("none"), [], DOC_SCHEMA)
