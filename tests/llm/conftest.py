from __future__ import annotations

import random

import pytest

#: Columns of documents and two that clash with names the operators might use.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, score double"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Build documents from (doc_id, text) pairs, with extra columns."""
    return lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 0.5) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def corpus():
    """Seeded documents with exact copies, near copies, shared passages, nulls, empty, short, odd and long texts."""
    rng = random.Random(7)
    words = [f"{a}{b}" for a in "abcdefghijkl" for b in ("ra", "to", "ne", "li", "sa", "ku")]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = say(60)
    rows: list[tuple[int, str | None]] = [(i, say(rng.randint(3, 160))) for i in range(60)]
    base = rows[5][1] + " " + say(120)
    rows += [(60, base), (61, base), (62, base.replace(" ", "  ").upper()), (63, base + " " + say(2))]
    for i in range(64, 70):
        ws = base.split()
        ws[rng.randrange(len(ws))] = "changed"
        rows.append((i, " ".join(ws)))
    rows += [(70 + k, f"{say(10 + k)} {passage} {say(5)}") for k in range(5)]
    rows += [(80, None), (81, ""), (82, " \t\n"), (83, "one"), (84, "one two"), (85, "ONE  two"), (86, None), (87, "Ünïcode ßtraße 漢字 🙂 " * 30), (88, "x" * 3000), (89, say(9000))]
    rows += [(90, passage), (91, passage[: len(passage) // 2]), (92, "  " + passage)]
    return rows
