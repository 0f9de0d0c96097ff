import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _quality int, _gone long, _id long, node long, digest string, score string"
SYLLABLES = "an the re ou er ti on ing ly ble nd st ha sh en at or es ed in wh éa ño ü tz".split()


def words(r, n):
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(n))


def row(doc_id, text, lang="en", source="src0"):
    """A document with extra columns whose names the operators use themselves."""
    return (doc_id, text, lang, source, None if text is None else len(text), 1, doc_id, doc_id, 7, "d", "x")


@pytest.fixture(scope="session")
def texts():
    """Texts with exact and near copies, shared passages, personal data and license lines."""
    r = random.Random(11)
    out = [words(r, r.randint(20, 220)) + "." for _ in range(60)]
    out += [out[3], out[3], out[5].upper()]
    for k in (7, 7, 8):
        w = out[k].split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    passage = words(r, 60)
    out += [words(r, 40) + " " + passage + "\n" + words(r, 30) for _ in range(3)]
    out += [words(r, 20) + " a.b-c%1@mail.example.com, 10.0.0.1 or 999.1.1.1 and 4111 1111 1111 1111 +1 (988) 555-2485 " + words(r, 9)]
    out += [words(r, 15) + f' token = "{k}b0b3c6a43eb78aa99cbd7049c572391524f37a8" ' + words(r, 5) for k in range(4)]
    out += [f"{words(r, 12)} {card} {words(r, 8)}" for card in (4111111111111111, 4012888888881881, 5555555555554444, 6011111111111117)]
    out += ["Released under the MIT License. " + words(r, 20), "This work is licensed under the GNU General Public License, version 3.\n" + words(r, 10), "cc by cc-by CC BY"]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts and the awkward rows: null id, null, empty, blank and very long texts, repeated rows, the smallest id last."""
    rows = [row(100 + k, t, lang=("en", "de", None)[k % 3], source=(None, "src0", "src1")[k % 3]) for k, t in enumerate(texts)]
    rows += [row(None, texts[0]), row(None, None), row(1, None), row(2, ""), row(3, " \t\n"), row(4, "x" * 120_000), row(5, "ab " * 30_000), row(6, "one two"), row(7, "One  TWO"), row(101, texts[1]), row(101, texts[1]), row(-5, "naïve \U0001f600 end")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
