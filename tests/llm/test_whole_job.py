"""Cases in which an operator once did less than the whole job."""

import math
import random

import numpy as np
import pyarrow as pa

from tidebook.llm import chosen_path, chunk_dedup, decontaminate, licenses, pii

from .conftest import words as made


def test_trees_keep_the_stated_recall():
    """A pair at the threshold, averaged over the tokens and marks that it shares: all trees choose from the same ones."""

    def chances(n):
        return [(k, math.comb(n, k) * 0.75**k * 0.25 ** (n - k)) for k in range(n + 1)]

    def lost(levels):
        out = 0.0
        for marks, p in chances(chosen_path.MARKS):
            parted, pick = 0.0, 1 / (chosen_path.BRANCH * chosen_path.MARKS)
            for _ in range(levels):
                parted = (1 - pick + pick * parted) ** marks
            pick = 1 / (chosen_path.BRANCH * chosen_path.TOKENS)
            out += p * sum(q * (1 - pick + pick * parted) ** (tokens * chosen_path.TREES) for tokens, q in chances(chosen_path.TOKENS))
        return out

    assert lost(0) < 1e-8 and lost(6) < 0.0003 and lost(chosen_path.Limits().depth) < 0.0008


def test_whatever_lies_within_the_budget_is_found():
    """Thousands of edit scripts of inserts, deletes and substitutions, also of one kind only; two occurrences a text."""
    r = random.Random(17)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for size in (20, 40, 85, 160, 240, 320):
        for script in range(150):
            item = "".join(r.choices(letters, k=size))
            one = decontaminate.index([(1, item)])
            kinds = ("insert", "delete", "replace") if script % 4 == 0 else (("insert", "delete", "replace")[script % 4 - 1],)

            def edited(item=item, budget=one.budget(0), kinds=kinds):
                near = list(item)
                for _ in range(budget):
                    k, kind = r.randrange(len(near)), r.choice(kinds)
                    near[k : k + 1] = {"insert": [near[k], r.choice(letters)], "delete": [], "replace": [r.choice(letters)]}[kind]
                return "".join(near)

            text = "".join(r.choices(letters, k=r.randint(0, 200))) + edited() + "".join(r.choices(letters, k=r.randint(50, 90))) + edited()
            got = decontaminate.matches(one, pa.array([text]))
            assert len(got) == 2 and all(x[4] <= one.budget(0) for x in got), (size, script)


def test_redaction_takes_any_number_of_patterns(spark):
    """21,000 cues, each learned from three addresses; every one announces a secret that no rule describes."""
    cues = ["q" + "".join("abcdefghij"[int(d)] for d in f"{k:05d}") for k in range(21_000)]
    rows = [(k // 100, " ".join(f"{c} 10.{k // 256 % 256}.{k % 256}.{n} ," for n in range(3)) + f" {c} {c}9{c}8 ,") for k, c in enumerate(cues)]
    docs = spark.createDataFrame([(i, " ".join(t for j, t in rows if j == i)) for i in range(0, 210)], "doc_id long, text string")
    got = {x["doc_id"]: x["text"] for x in pii.redacted(docs).collect()}
    assert got == {i: " ".join(f"{c} <IP> , {c} <IP> , {c} <IP> , {c} <IDENTIFIER> ," for c in cues[100 * i : 100 * i + 100]) for i in range(210)}


def test_long_secrets_are_found_whole(spark):
    secrets = ["9b0b3c6a43eb78aa99cb" * 15, "Ab9/" * 200, "x" * 5000 + "7"]
    docs = spark.createDataFrame([(k, f'token = "{s}" end') for k, s in enumerate(secrets)], "doc_id long, text string")
    got = {r["doc_id"]: [(s["start"], s["value"]) for s in r["found"]] for r in pii.extract(docs, cues=("token",)).collect()}
    assert got == {k: [(9, s)] for k, s in enumerate(secrets)}
    assert {r["text"] for r in pii.redacted(docs, cues=("token",)).collect()} == {'token = "<IDENTIFIER>" end'}


def test_long_tokens_take_linear_time():
    for text in ("x" * 400_000 + "1", "x1 " * 100_000, "1x" * 200_000):
        assert sum(e - s for s, e, _, _ in pii.instances(text, [])) <= len(text)


def test_all_notices_of_a_text_are_recognised(spark):
    of = lambda *labels: ". ".join(t for x, t in licenses.NOTICES if x in labels)
    sets = [("gpl", "mit", "bsd"), ("gpl", "apache", "mit", "bsd"), tuple(sorted(licenses.KEYS))]
    docs = spark.createDataFrame([(k, of(*labels)) for k, labels in enumerate(sets)] + [(9, "plain text")] * 50, "doc_id long, text string")
    got = {r["doc_id"]: r["found"] for r in licenses.scan(docs).collect()}
    assert got == {0: sorted(sets[0]), 1: sorted(sets[1]), 2: list(sets[2]), 9: []}


def test_repeats_of_little_over_fifty_words_are_caught(spark):
    r = random.Random(29)
    rows = []
    for k in range(0, 800, 2):
        passage = made(r, r.randint(51, 60))
        rows += [(k + j, f"{made(r, 60)} {passage} {made(r, 60)}") for j in (0, 1)]
    caught = {x["doc_id"] for x in chunk_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(caught) >= 796


def test_cuts_depend_on_their_row_only():
    r = random.Random(31)
    rows = [made(r, r.choice([0, 1, 3, 40, 300])).encode() for _ in range(200)]
    at = np.cumsum([0, *map(len, rows)])
    ends = chunk_dedup.chunk_ends(np.frombuffer(b"".join(rows), np.uint8), at)
    for k, row in enumerate(rows):
        alone = chunk_dedup.chunk_ends(np.frombuffer(row, np.uint8), np.array([0, len(row)])).tolist() if row else []
        assert [e - at[k] for e in ends.tolist() if at[k] < e <= at[k + 1]] == alone
