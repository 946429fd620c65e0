"""Small tables with every awkward case."""

from __future__ import annotations

WORDS = "the quick brown fox jumps over a lazy dog while seven grey geese watch from afar".split()

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # Names that operators use themselves.
    " size long, score double, shard int, node long, bucket string, `COMPONENT` int"
)


def prose(number: int, words: int = 30) -> str:
    return " ".join(f"{WORDS[(number * 7 + i * i) % len(WORDS)]}{(number + i) % 11}" for i in range(words))


def rows() -> list[tuple]:
    """Ids, texts, languages and sources; NULLs, empty and long texts, ties and repeated rows."""
    found = [(i, prose(i), "en", f"s{i % 3}") for i in range(20)]
    found += [
        (20, None, "en", "s1"),
        (21, "", None, None),
        (22, " \t\n ", "de", "s2"),
        (23, "12 34 !!", "fr", "s0"),
        (24, prose(3), "en", "s0"),
        (25, "Ärger über größte Straßen ist schön heute " * 400, "de", "s1"),
        (26, "l'été où la forêt dorée était déjà là " * 30, "fr", "s1"),
        (27, "x" * 5000, "en", "s1"),
        (28, "one two", "en", None),
        (28, "one two", "en", None),
        (28, prose(5), "en", "s2"),
        (None, prose(4), None, "s2"),
        (None, None, None, None),
    ]
    return found


def documents(spark, found=None):
    """A frame of ``rows`` with extra columns of clashing names."""
    found = rows() if found is None else found
    full = [(i, t, lang, s, None, 5, 0.5, 1, 7, "b", 2) for i, t, lang, s in found]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
