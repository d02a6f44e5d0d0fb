"""Small tables with the cases every operator must stand."""

import public_tokenizers

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, part string"

LONG = " ".join(f"word{i} and more, thing" for i in range(3000))

ODD_TEXTS = [
    None, "", " ", "a", "Plain words, plain words.", "Plain words, plain words.", "It's 42 o'clock; we'll see!!",
    "ÀÉÎ naïve Straße über", "é K İ Σ ſ", "你好 \U0001f600 x y\x1cz",
    "<|endoftext|> a <|startoftext|>b", "tab\tnew\nline\r\nend", "\x00\x0b\x0c \x7f", LONG, "x" * 5000,
]


def documents(spark, texts=None, ids=None):
    """Rows with extra columns whose names operators use themselves."""
    texts = ODD_TEXTS if texts is None else texts
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, None, None, "kept", "kept") for i, t in zip(ids, texts)], DOCUMENTS)
