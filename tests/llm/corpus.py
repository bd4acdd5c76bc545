"""Small corpora for the operator tests: copies, shared passages and every odd case a table may hold."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, part int, spans string, row string"


def documents(seed: int = 1, n: int = 40) -> list[tuple]:
    """Rows of :data:`SCHEMA` (with names that clash with columns used inside the operators)."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abdeiklnorstuéüñ") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, line = prose(60), "shared line of every site " + prose(4)
    texts: list[str | None] = [None, "", " \t\n", "one", "one two three", "\n\n", "%%% ###", "7 8 9", "Ünï Æ \U0001f642 日本"]
    for i in range(n):
        text = prose(rng.randint(1, 120))
        if i % 3 == 0:
            text = f"{text} {passage} {prose(rng.randint(0, 30))}"
        if i % 4 == 0:
            text = f"{line}\n{text}\n  {line}\t\n{prose(5)}"
        texts.append(text)
    texts += [texts[-1], texts[-2], texts[-2].replace(" ", "  "), prose(3000) + " " + passage, passage, (passage + "\n") * 3]
    near = prose(200).split()
    for k in range(5):
        near[rng.randrange(200)] = "changed"
        texts.append(" ".join(near))
    rows = [(i * 3 % 1000, t, ["en", "de", None, "fr"][i % 4], f"site{i % 13}" if i % 7 else None, None if t is None else len(t), i, i, "x", "y")
            for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [rows[3], rows[5], rows[5], (None, "a row without an id " + passage, "en", "site1", 5, 0, 0, None, None)]


def frame(spark, rows: list[tuple], parts: int = 3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
