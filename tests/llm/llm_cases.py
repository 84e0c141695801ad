"""Small tables with the odd rows that every operator must take."""

import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    """Deterministic words of no meaning."""
    out = []
    for _ in range(n):
        seed = (seed * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append("abcdefghij"[seed >> 60 & 7] + str(seed >> 40 & 255) + "xyz"[seed >> 33 & 1])
    return " ".join(out)


def edited(text: str, every: int, mark: str) -> str:
    found = text.split(" ")
    return " ".join(mark + w if i % every == every - 1 else w for i, w in enumerate(found))


def texts() -> list[tuple[int, str | None]]:
    base = prose(1, 300)
    shared = prose(2, 70)
    lines = "\n".join(prose(k, 8) for k in range(20, 26))
    return [
        (10, None),
        (11, ""),
        (12, " \t\n\x0b "),
        (13, "word"),
        (14, "Word "),
        (15, "one two three"),
        (16, base),
        (17, base),
        (18, base.replace(" ", "  ")),
        (19, edited(base, 60, "q")),
        (20, edited(base, 61, "r")),
        (21, prose(3, 120) + " " + shared + " " + prose(4, 90)),
        (22, prose(5, 33) + " " + shared + "\n" + prose(6, 11)),
        (23, prose(7, 9000)),
        (24, "é Ünï 日本語  nb sp \x1c x " + prose(8, 60)),
        (25, lines + "\n" + lines),
        (26, prose(9, 5) + "\n" + lines + "\n\n" + prose(10, 5)),
        (27, "a b " * 400),
        (28, "x" * 3000),
        (29, "mail ann@example.com or +1 (212) 555-0143, ip 10.0.0.1 and 4111 1111 1111 1111, (499) 555-6503."),
        (29, "mail ann@example.com or +1 (212) 555-0143, ip 10.0.0.1 and 4111 1111 1111 1111, (499) 555-6503."),
        (30, "<|endoftext|> it's 12,345 don’t   stop"),
    ]


def rows() -> list[tuple]:
    return [(i, t, "en", "src0", None if t is None else len(t)) for i, t in texts()]


def table(spark, extra: bool = False):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    if extra:
        for name in ("key", "score", "row", "text_", "kept", "node", "block", "pos", "new_text"):
            df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def folder(spark, path, df=None) -> str:
    (table(spark) if df is None else df).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return str(path)


def words(text: str | None, fold: bool = False) -> list[str]:
    return WORD.findall((text or "").translate(LOWER) if fold else (text or ""))


def shingles(text: str | None, n: int) -> set:
    w = words(text, True)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def classes(given: list[tuple[int, str | None]], n: int, percent: int) -> dict[int, int]:
    sets = [(i, shingles(t, n)) for i, t in given]
    root = {i: i for i, _ in given}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = sorted((top(a), top(b)))
                root[v] = u
    return {i: top(i) for i in root}


def held_out_of_seven(key: int) -> bool:
    return zlib.crc32(str(key).encode()) % 7 == 2
