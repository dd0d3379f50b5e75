"""Small documents that hold every awkward case."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size long, place string, bucket int, key string, fp string, body string, score string, ids string, target string, "
    "n int, lines string, at int, words string, part int, shard int, root string, node string"
)
_EXTRA = (9, "p", 1, "k", "f", "b", "s", "i", "t", 2, "l", 3, "w", 4, 5, "r", "o")


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), *_EXTRA)


def texts(n: int, seed: int = 3) -> list[str]:
    """Invented prose with lines."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("aeioubcdfglmnprst", k=rng.randint(1, 9))) for _ in range(300)]
    out = []
    for _ in range(n):
        lines = []
        for _ in range(rng.randint(1, 7)):
            words = rng.choices(vocabulary, k=rng.randint(1, 15))
            lines.append(" ".join(words).capitalize() + ".")
        out.append("\n".join(lines))
    return out


def awkward() -> list[tuple]:
    """NULLs in every column, empty and long texts, copies, repeated rows, odd characters."""
    plain = texts(30)
    rows = [row(i, t, source=f"s{i % 4}") for i, t in enumerate(plain)]
    rows += [
        row(40, None),
        row(41, ""),
        row(42, " \t\n\n "),
        row(43, "word"),
        row(44, "Straße Ünï çödé — “quotes” 🙂🙂 𝔘𝔫𝔦 İstanbul ΑΣ áé"),
        row(45, "x" * 30_000),
        row(46, ("many words again and again " * 4000).strip()),
        row(47, plain[0], None, None),
        row(48, plain[0], "en", "s0"),
        row(49, plain[1]),
        row(49, plain[1]),
        row(50, plain[2] + "\n" + plain[3]),
        row(None, plain[4]),
        row(None, None, None, None),
        row(51, "tab\there\x0bvertical\x0cform\x1cfile\x85next\xa0space wide"),
        row(52, "Line one here.\nLine one here.\nLine one here.\nLine one here.\nLine one here."),
        (None,) * (5 + len(_EXTRA)),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
