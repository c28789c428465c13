"""Hostile rows and brute-force forms shared by the tests of this folder."""

import random

LOWER = bytes(b + 32 if ord("A") <= b <= ord("Z") else b for b in range(256))
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return (text or "").encode().split()


def lowered(text):
    return (text or "").encode().translate(LOWER).split()


def documents(spark, rows):
    """``rows`` are (doc_id, text[, lang])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def corpus(seed=1, n=60, vocabulary=400):
    """Random texts with exact copies, near copies, shared passages, hostile texts and a hot text."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß漢") for _ in range(rng.randint(1, 6))) for _ in range(vocabulary)]
    line = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage = line(20)
    texts = [line(rng.randint(1, 80)) + "\n" + line(rng.randint(5, 40)) for _ in range(n)]
    for k in range(0, n, 6):
        own = texts[k].split(" ")
        texts[k + 1] = texts[k]  # exact copy
        own[len(own) // 2] = "changed"
        texts[k + 2] = " ".join(own)  # near copy
        texts[k + 3] += " " + passage
    hostile = [None, "", " \t\r\n\x0b ", "\n\n", "one", "Two words", "UPPER upper", "! ? ...", "x" * 5000, "\x00nul\x1cbytes\x85 next", passage]
    texts += hostile + ["the same hot text in many rows of this table again and again, word by word"] * 12
    return list(enumerate(texts))
