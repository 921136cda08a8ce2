"""Small tables with every awkward case, and plain versions to compare with."""

import re

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
_LOWER = {i: i + 32 for i in range(65, 91)}


def documents(spark, rows, more=""):
    """Rows of (id, text), with extra columns named like results where ``more`` asks for them."""
    data = [(i, t, "en", "s", len(t or ""), *[7] * len(more.split())) for i, t in rows]
    extra = "".join(f", {c} int" for c in more.split())
    return spark.createDataFrame(data, DOCUMENTS + extra)


def white_space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))


def benchmark_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(_LOWER))


def gathered(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
