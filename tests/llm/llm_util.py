"""Small tables for the tests of the llm operators."""

import random

import public_tokenizers

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt ut labore et dolore magna aliquyam".split()


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", "."]) for _ in range(n))


def documents(spark, texts, first=0, schema=DOCS):
    """Documents with ids from ``first``; a text may be given as (id, text)."""
    rows = [t if isinstance(t, tuple) else (i + first, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows], schema)


def edge_texts():
    """Null, empty and blank texts, a very long one, a long word, repeated rows and odd characters."""
    return [None, "", " \n\t ", prose(1, 30_000), "x" * 50_000, prose(2), prose(2), (None, prose(3)), (5, prose(4)), (5, prose(4)), "İﬁ ½ 漢字 \U0001F600 \x1c\x85 <|endoftext|>"]


def clashing(df):
    """Columns by the names that operators make or use inside."""
    for c in sorted({"score", "spans", "id", "key", "component_id", "n_tokens", "block", "epoch", "slot", "label", "start", "size", "tokens", "x"} - set(df.columns)):
        df = df.selectExpr("*", f"'own' as {c}")
    return df


def tokenizer_path(name):
    return public_tokenizers.path(name)
