"""Hand-made rows with every awkward case."""

from __future__ import annotations

import random

#: Names that the operators use for results or inside.
CLASHING = "n_words kept spans items score host path rule label size shard slot token bucket doc set_id c0 row _row lines n ids decoded"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING.split())


def texts(seed: int = 5) -> list[str | None]:
    draw = random.Random(seed)
    word = lambda: draw.choice(["alpha", "Beta", "gamma,", "délta", "eps%", "zeta", "eta", "idiot", "x"]) + draw.choice(["", "1", "22", "s"])
    line = lambda n: " ".join(word() for _ in range(n))
    base = line(60)
    near = base.split()
    near[30] = "CHANGED"
    passage = [line(8) for _ in range(5)]
    long = "\n".join(line(9) for _ in range(900))
    return [
        None,
        "",
        " \n\t ",
        "one",
        "One",
        "two words",
        base,
        base,
        base.upper(),
        " ".join(near),
        "\n".join([line(7), *passage, line(7)]),
        "\n".join([*passage, line(5), *passage]),
        "\n".join(["same line"] * 9),
        "a\n\nb\n\nc\n\n\na\nb\nc\n",
        long,
        long + " end",
        "x" * 5000,
        "日本語 テキスト 😀 " * 20,
        "\u0085  odd blanks \x0b\x0c\r\n",
        *[line(draw.randint(1, 120)) for _ in range(25)],
        *["\n".join([line(6), *passage[:3], line(4)]) for _ in range(6)],
    ]


def documents(spark, own: list | None = None):
    rows = []
    for i, text in enumerate(texts() if own is None else own):
        lang, source = ["en", "de", None][i % 3], ["hot", "hot", "rare", None][i % 4]
        rows.append((i, text, lang, source, None if i % 5 == 0 else len(text or ""), *[f"{c}{i}" for c in CLASHING.split()]))
    if own is None:
        rows.append((None, *rows[6][1:]))
        rows += [rows[9], rows[9], rows[14], rows[1]]
        rows.append((3, *rows[7][1:]))
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)
