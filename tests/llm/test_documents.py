"""Operators on single documents and on groups of them, against plain versions and on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidebook.llm import _shared, chosen_path, chunk_dedup, cotraining, decontaminate, kneser_ney, licenses, merkle, packing, pii, toxic_crf

from .conftest import words as made

LOWER = {i: i + 32 for i in range(65, 91)}
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def words(text):
    return [w for w in SPACES.split((text or "").translate(LOWER)) if w]


# ------------------------------------------------------------------------- packing


def test_pieces_equal_the_tokenizers_library(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    want = []
    for i, text in rows_of(docs):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) if len(ids) <= 256 else len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids), 256), len(ids)] if len(ids) > first else [0, len(ids)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = packing.pack_documents(docs, capacity=256).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)
    full = collections.defaultdict(list)
    for r in got:
        full[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in full.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    assert len(full) <= math.ceil(sum(r["length"] for r in got) / 256) * 1.02 + 1


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_every_length_once(seed):
    r = np.random.default_rng(seed)
    counts = np.zeros(65, np.int64)
    for n in r.integers(1, 65, 300):
        counts[n] += 1
    plan = packing.packing_plan(counts, 64)
    for n in range(1, 65):
        ranks = sorted((f, q) for m, f, q, _, _ in plan.tolist() if m == n)
        assert not ranks or ranks[0][0] == 0
    assert packing.packing_plan(np.zeros(65, np.int64), 64).shape == (0, 5)


def test_smallest_gives_way_to_two():
    # 60 + 30 leaves 10 of 100: 30 gives way to 21 + 19, which fills the bin
    counts = np.zeros(101, np.int64)
    counts[[60, 30, 21, 19]] = 1
    plan = packing.packing_plan(counts, 100).tolist()
    assert sorted(n for n, _, s, _, _ in plan if s == 0) == [19, 21, 60]


def test_a_wrong_length_is_refused(spark):
    parts = _shared.written(spark.createDataFrame([(1, 0, 0, 300, 5)], "doc_id long, piece int, start long, length long, ids_crc32 long"), "parts")
    with pytest.raises(ValueError, match="300"):
        packing.packed(parts, capacity=256)


# ------------------------------------------------------------------- near-duplicates


def test_classes_equal_brute_force(docs):
    rows = [r for r in rows_of(docs) if r[0] is not None]
    sets = collections.defaultdict(list)
    for i, text in rows:
        w = words(text)
        sets[i].append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and any(100 * len(a & b) >= 75 * len(a | b) > 0 for a in sets[i] for b in sets[j]):
                a, b = sorted((root(i), root(j)))
                top[b] = a
    got = chosen_path.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["component_id"], r["n_shingles"], r["kept"]) == (root(r["doc_id"]), len(sets[r["doc_id"]][0]), root(r["doc_id"]) == r["doc_id"])
    kept = chosen_path.deduplicated(docs)
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert kept.columns == docs.columns and sorted(i for i in ids if i is not None) == sorted({root(i) for i in sets}) and ids.count(None) == 2


LIMITS = (
    chosen_path.Limits(leaf=8, outside=3, depth=3),  # tasks branch
    chosen_path.Limits(leaf=8, outside=3, local=16, depth=1, members=5, broadcast=0),  # nodes branch through shuffles and end in blocks, nothing is broadcast
    chosen_path.Limits(sets=100),  # pair by pair
)


@pytest.mark.parametrize("limits", LIMITS)
def test_large_and_mixed_nodes(spark, limits):
    """Whatever way a node takes, no link is lost."""
    r = random.Random(3)
    base = [str(r.randint(0, 10**6)) for _ in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in r.sample(range(120), r.choice([1, 2, 3, 5])):
            w[k] = str(r.randint(0, 10**6))
        rows.append((i, " ".join(w)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(116)} for i, t in rows}
    top = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    top[i] = top[j] = min(top[i], top[j])
    got = {x["doc_id"]: x["component_id"] for x in chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), limits=limits).collect()}
    assert got == top


def test_an_id_of_several_texts_links_their_classes(spark):
    one, two = "a b c d e f g one", "other words in this text here two"
    docs = spark.createDataFrame([(3, one, "p"), (7, one, "q"), (7, two, "r"), (9, two, "s"), (9, two, "s"), (5, "", "t"), (5, two.upper(), "u")], "doc_id long, text string, source string")
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in chosen_path.near_duplicates(docs).collect())
    assert got == [(3, 3, True), (5, 3, False), (5, 5, True), (7, 3, False), (7, 3, False), (9, 3, False), (9, 3, False)]
    left = sorted(map(tuple, chosen_path.deduplicated(docs).collect()))
    assert left == [(3, one, "p"), (5, "", "t"), (5, two.upper(), "u")]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = dict(map(tuple, _shared.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), 100: 90, 90: 90, 95: 90}


# ------------------------------------------------------------------ repeated passages


def test_repeated_passages(docs, texts):
    got = chunk_dedup.repeats(docs).collect()
    caught = {r["doc_id"] for r in got}
    grams = collections.defaultdict(set)
    for i, text in rows_of(docs):
        w = words(text)
        for k in range(len(w) - 50):
            grams[tuple(w[k : k + 51])].add(i)
    assert {i for s in grams.values() if len(s - {None}) > 1 for i in s - {None}} <= caught
    short = collections.defaultdict(set)
    for i, text in rows_of(docs):
        w = words(text)
        for k in range(len(w) - 19):
            short[tuple(w[k : k + 20])].add(i)
    assert caught <= {i for s in short.values() if len(s - {None}) > 1 for i in s}
    assert all(r["keeps"] == (r["doc_id"] == r["first_doc_id"]) and r["first_doc_id"] <= r["doc_id"] for r in got)


def test_every_repeated_passage_is_kept_once(spark):
    """Parts against the texts: what is left after taking all parts that aren't kept holds every passage once."""
    from tests.llm.conftest import words as made

    r = random.Random(43)
    a, b, c = (made(r, 90) for _ in range(3))
    sep = lambda: " " + made(r, 30) + " "
    texts = {1: sep() + a + sep(), 4: sep() + a + " " + b + sep(), 5: sep() + a + " " + b + sep(), 6: c + " " + b, 7: sep() + c + sep(), 8: a, 9: sep()}
    rows = [*texts.items(), (8, a), (5, sep()), (10, None)]
    got = chunk_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = dict(texts)
    flat = lambda t: " ".join(t.lower().split())
    for x in sorted(got, key=lambda x: -x["start"]):
        part = texts[x["doc_id"]][x["start"] : x["stop"]]
        assert flat(part) in flat(texts[x["first_doc_id"]]) and x["keeps"] == (x["doc_id"] == x["first_doc_id"]) and abs(len(part.split()) - x["n_words"]) <= 2
        assert not any(y is not x and y["doc_id"] == x["doc_id"] and y["start"] < x["stop"] and x["start"] < y["stop"] for y in got)
        if not x["keeps"]:
            t = left[x["doc_id"]]
            left[x["doc_id"]] = t[: x["start"]] + "|" + t[x["stop"] :]
    for passage in (a, b, c):
        inner = flat(passage)[100:-100]
        for k in range(0, len(inner) - 40, 20):
            assert sum(inner[k : k + 40] in flat(t) for t in left.values()) == 1
    assert len({(x["doc_id"], x["start"]) for x in got}) == len(got) and {x["doc_id"] for x in got} == {1, 4, 5, 6, 7, 8}


def test_an_insertion_moves_no_far_cut():
    text = np.frombuffer(" ".join(str(hash((k, 1)) % 10**6) for k in range(400)).encode(), np.uint8)
    more = np.concatenate([text[:500], np.frombuffer(b" inserted ", np.uint8), text[500:]])

    def cut(t):
        ends = chunk_dedup.chunk_ends(t, np.array([0, len(t)])).tolist()
        return {bytes(t[a:b]) for a, b in zip([0, *ends], ends)}

    assert len(cut(text) - cut(more)) <= 4


# -------------------------------------------------------------------- decontamination


def distance(item, region):
    """Fewest edits between item and any part of region."""
    row = [0] * (len(region) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(region, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edits_equal_a_plain_alignment():
    r = random.Random(5)
    for _ in range(60):
        item = bytes(r.choice(b"abc") for _ in range(r.randint(1, 12)))
        region = bytes(r.choice(b"abc") for _ in range(r.randint(0, 25)))
        cost, begin, end = decontaminate.edits(item, region, -12, 25, 12)
        assert cost == distance(item, region)
        assert distance(item, region[begin:end]) == cost


def test_the_alignment_keeps_to_its_band():
    """Against plain dynamic programming over the cells of the band."""
    r = random.Random(6)
    for _ in range(200):
        item = bytes(r.choice(b"ab") for _ in range(r.randint(1, 9)))
        text = bytes(r.choice(b"ab") for _ in range(r.randint(0, 14)))
        low = r.randint(-6, 10)
        high = low + r.randint(0, 5)
        cells = {(0, j): 0 for j in range(len(text) + 1) if low <= j <= high}
        for i in range(len(item) + 1):
            for j in range(len(text) + 1):
                if low <= j - i <= high:
                    ways = [cells.get((i - 1, j - 1), 99) + (j > 0 and i > 0 and item[i - 1] != text[j - 1]), cells.get((i - 1, j), 99) + 1, cells.get((i, j - 1), 99) + 1]
                    cells[i, j] = min(cells.get((i, j), 99), *ways)
        want = min((v for (i, _), v in cells.items() if i == len(item)), default=99)
        cost, begin, end = decontaminate.edits(item, text, low, high, 9)
        assert min(cost, 10) == min(want, 10)
        assert cost > 9 or distance(item, text[begin:end]) <= cost


def test_every_occurrence_of_a_short_item(spark):
    docs = spark.createDataFrame([(1, "Abc def x, abc-def abc def. xabc def"), (2, "abc"), (3, "def")], "doc_id long, text string")
    items = spark.createDataFrame([(4, "abc def"), (5, "abc")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["start"], r["stop"]) for r in decontaminate.contaminated(docs, items).collect())
    assert got == [(1, 4, 0, 7), (1, 4, 11, 18), (1, 4, 19, 26), (1, 5, 0, 3), (1, 5, 11, 14), (1, 5, 19, 22), (2, 5, 0, 3)]


def test_passages_are_found_with_edits(spark, docs, texts):
    item = texts[10]
    near = list(item)
    for k in range(5, len(near), 60):
        near[k] = "q"
    far = list(item)
    for k in range(5, len(far), 6):
        far[k] = "q"
    norm = lambda t: " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").translate(LOWER)))
    rows = [(1, f"before {item.translate({i + 32: i for i in range(65, 91)})} after"), (2, "x " + "".join(near) + " y"), (3, "".join(far)), (4, None), (5, "tiny"), (None, item)]
    items = spark.createDataFrame([(9, item), (8, None), (7, "  "), (6, "tiny")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert set(got) == {(1, 9), (2, 9), (None, 9), (5, 6)}
    assert norm(rows[0][1][got[1, 9]["start"] : got[1, 9]["stop"]]) == norm(item) and 0 < got[2, 9]["edits"] <= 0.05 * len(item.encode())
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    left = decontaminate.without_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == sum(norm(item) not in norm(t) for _, t in rows_of(docs))


# ----------------------------------------------------------------------------- licenses


def test_license_scan_equals_brute_force(docs):
    got = sorted(((r["doc_id"], r["n_words"], sorted((p["start"], p["label"]) for p in r["places"])) for r in licenses.scan(docs).collect()), key=str)
    want = []
    for i, text in rows_of(docs):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        want.append((i, len(w), sorted(places)))
    assert got == sorted(want, key=str)


def test_notices_are_recognised(spark):
    rows = [(k, f"Some file. {text.title()}. More text follows.") for k, (_, text) in enumerate(licenses.NOTICES)] + [(99, "license warranty software gnu apache"), (98, None)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (label, _) in enumerate(licenses.NOTICES):
        assert label in got[k]["found"] and 0 < got[k]["score"] <= 1
    assert got[99]["found"] == [] and got[98]["n_words"] == 0 and got[98]["score"] == 0


def test_license_plan_has_no_python(docs):
    assert not re.search("Python|Pandas|Arrow", licenses.scan(docs)._jdf.queryExecution().toString().split("== Physical Plan ==")[1])


# --------------------------------------------------------------------------- fingerprints


def test_fingerprints(docs):
    rows = [(i, t or "") for i, t in rows_of(docs) if i is not None and i not in (101,)]
    table = docs.filter("doc_id is not null and doc_id <> 101")
    order = sorted(rows, key=lambda r: -r[0])
    got = {r["doc_id"]: r for r in merkle.edited_fingerprints(table).collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(order):
        follow = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        r = got[i]
        assert (r["n_chars"], r["edited"]) == (len(text), edited)
        assert [r["fingerprint"], r["edited_fingerprint"]] == merkle.fingerprint([text, edited])
        assert r["near_edited"] == merkle.likeness(r["fingerprint"], r["edited_fingerprint"]) and r["near_next"] == merkle.likeness(r["fingerprint"], got[order[(k + 1) % len(order)][0]]["fingerprint"])
        assert (edited == text) == (r["near_edited"] == 1.0)
    assert merkle.edited_fingerprints(docs).count() == docs.count()


def test_trees_locate_edits():
    lines = [f"paragraph {k} " + "word " * (k % 7) for k in range(60)]
    changed = list(lines)
    changed[30] += "!"
    a, b = merkle.fingerprint(["\n".join(lines), "\n".join(changed)])
    assert len(merkle.differing(a, b)) == 1 and 0.9 < merkle.likeness(a, b) < 1 and merkle.differing(a, a) == []
    assert len(set(merkle.fingerprint(["", " ", "\n", "\n\n", "a", "a\n", "a\n\n"]))) == 7


# ------------------------------------------------------------------------- language model


def test_scores_equal_a_plain_model(docs):
    rows = rows_of(docs)
    learn = [t for i, t in rows if i is not None and i % 2 == 0]
    got = collections.defaultdict(list)
    for r in kneser_ney.scored(docs, F.col("doc_id") % 2 == 0).collect():
        got[r["doc_id"]].append(r)
    count, pairs = collections.Counter(), collections.Counter()
    for t in learn:
        w = [*words(t), "<end>"]
        count.update(w)
        pairs.update(zip(["<start>", *w], w))
    disc = lambda n: kneser_ney._discounts(np.array([sum(v == k for v in n.values()) for k in range(1, 5)]))
    cont, followers = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
    for (u, w), n in pairs.items():
        cont[w] += 1
        followers[u][min(n, 3) - 1] += 1
    d, low, total, size = disc(pairs), disc(cont), {**count, "<start>": len(learn)}, len(count) + 1
    spare = sum(low[min(n, 3)] for n in cont.values()) / len(pairs)

    def one(w):
        return (cont[w] - low[min(cont[w], 3)]) / len(pairs) * (w in cont) + spare / size

    def two(u, w):
        if not total.get(u):
            return one(w)
        n = pairs[u, w]
        return max(n - d[min(n, 3)], 0) / total[u] * (n > 0) + sum(a * b for a, b in zip(d[1:], followers[u])) / total[u] * one(w)

    assert sum(one(w) for w in count) + spare / size == pytest.approx(1)
    assert sum(two("<start>", w) for w in count) + two("<start>", "?") == pytest.approx(1)
    n_all = sum(count.values())
    assert sum(map(len, got.values())) == len(rows)
    for i, text in rows:
        w = [*words(text), "<end>"]
        want = sum(math.log10(two(u, x)) for u, x in zip(["<start>", *w], w))
        base = sum(math.log10((count[x] + 0.5) / (n_all + 0.5 * size)) for x in w)
        assert any(r["n_tokens"] == len(w) and r["n_known"] == sum(x in count for x in w) and r["train_tokens"] == n_all and r["score"] == pytest.approx(want) and r["base_score"] == pytest.approx(base) for r in got[i])


def test_a_model_of_nothing(docs):
    r = kneser_ney.scored(docs, F.lit(False)).first()
    assert r["train_tokens"] == 0 and r["score"] == 0 and r["base_score"] == 0


# -------------------------------------------------------------------------- personal data

RULES = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def plain_spans(text):
    out = []
    for kind, rule in RULES:
        for m in re.finditer(rule, text):
            s, d = m.group(), re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in s.split(".")), "card": 13 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("seed", range(300))
def test_base_spans_equal_the_rules(seed):
    r = random.Random(seed)
    text = "".join(r.choice(["a", "B9", "@", ".", "@x.y", "1", "23", " ", "-", "+1", "4111111111111111", "(", ")", "é", "255.", "1.2.3.4", "%_"]) for _ in range(40))
    assert pii.base_spans(text) == plain_spans(text)


def test_extraction(docs):
    got = pii.extract(docs).collect()
    assert len(got) == docs.count()
    text = dict(rows_of(docs))
    for r in got:
        if r["doc_id"] is not None:
            assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == plain_spans(text[r["doc_id"]] or "")
            assert all(text[r["doc_id"]][s["start"] : s["end"]] == s["value"] for s in [*r["base"], *r["found"]])
    assert sorted(s["value"][0] for r in got for s in r["found"]) == ["0", "1", "2", "3"]  # the secrets, from cards and the like
    clean = pii.redacted(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    for r in clean.collect():
        assert r["text"] is None or not plain_spans(r["text"]) and "b0b3c6a" not in r["text"] and r["n_chars"] == len(r["text"])


def test_the_graph_equals_a_plain_loop(spark):
    """Patterns and instances scored by plain dictionaries; ordinary words make a cue worse, common tokens a form."""
    r = random.Random(41)
    card = lambda: next(n for n in iter(lambda: str(r.randrange(4 * 10**15, 5 * 10**15)), "") if pii.luhn(n))
    texts = [f"pay {card()} now" for _ in range(12)] + [f"key: {r.randrange(16**15, 16**16):016x} end" for _ in range(9)]
    texts += [f"see part{r.randrange(100, 999)}no" for _ in range(6)] + [f"{w} covid1920x and pay nothing" for w in "some words before it make this one quite ordinary".split()] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    edges, held, total = collections.defaultdict(dict), collections.Counter(), collections.Counter()
    for t in texts:
        for o in pii.observed(t, pii.base_spans(t)):
            for p in o["patterns"]:
                edges[p][o["value"]] = o["seed"]
                held[p] += 1
        for m in pii._JOINED.finditer(t):
            total[f"left {m[1].lower()} {m[2] or m[3] or ''}"] += 1
            total[f"right {m[1].lower()}"] += 1
    lefts = collections.Counter(v for p, vs in edges.items() if p.startswith("left ") for v in vs)
    given = {v: 1.0 if seed else 0.0 for vs in edges.values() for v, seed in vs.items() if seed or lefts[v] >= pii.COMMON}
    ordinary = {p: max(0, total[p] - held[p]) for p in edges}
    graph = {p: list(vs) for p, vs in edges.items() if len(vs) >= pii.SUPPORT and held[p] >= pii.CONFIDENT / 2 * (held[p] + ordinary[p])}
    score = {}
    for _ in range(pii.ROUNDS):
        known = score | given
        good = {p: sum(known.get(v, 0) for v in vs) / (sum(1 if v in known else pii.UNKNOWN for v in vs) + ordinary[p]) * len(vs) / (len(vs) + 1) for p, vs in graph.items()}
        score = {}
        for v in {v for vs in graph.values() for v in vs} - set(given):
            wrong = 1.0
            for p, vs in graph.items():
                wrong *= 1 - min(good[p], 0.999) * (v in vs)
            if 1 - wrong >= pii.SCORED:
                score[v] = 1 - wrong
    want = {v for v, c in score.items() if c >= pii.CONFIDENT}
    got = {s["value"] for x in pii.extract(docs).collect() for s in x["found"]}
    assert got == want and len(want) >= 9 and "covid1920x" not in want


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1 " * 60_000, "a@" * 60_000):
        pii.base_spans(text)


# ---------------------------------------------------------------------- quality, toxicity


def labelled(spark, n, make):
    r = random.Random(9)
    rows = [make(r, k) for k in range(n)]
    docs = spark.createDataFrame([(k, t, "en", f"src{k % 3}", len(t)) for k, (t, _) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame([(k, y) for k, (_, y) in enumerate(rows)], "doc_id long, y int"), {k: y for k, (_, y) in enumerate(rows)}


def good_or_bad(r, k):
    from tests.llm.conftest import words as made

    t = made(r, r.randint(30, 120))
    return (t, 1) if k % 4 else ("!! ".join(t.upper().split()), 0)


def toxic_or_not(r, k):
    from tests.llm.conftest import words as made

    w = made(r, r.randint(30, 120)).split()
    if k % 3 == 0:
        for _ in range(3):
            w.insert(r.randrange(len(w)), r.choice(["rotten", "foulish", "vileness"]))
    return " ".join(w), int(k % 3 == 0)


def test_quality_is_learned(spark):
    docs, labels, y = labelled(spark, 400, good_or_bad)
    got = {r["doc_id"]: r["score"] for r in cotraining.scored(docs, labels.filter("doc_id < 250"), label_col="y").collect()}
    assert sum((got[k] >= 0.5) == bool(y[k]) for k in range(250, 400)) >= 147


def test_cotraining_equals_plain_sums(spark):
    """Scores against the same models fed by a loop over all unlabelled rows, one at a time."""
    docs, labels, y = labelled(spark, 300, good_or_bad)
    rows = sorted(map(tuple, docs.collect()))
    feats = cotraining.content_features(pa.array([r[1] for r in rows], pa.string()))
    meta = cotraining.metadata_features([r[2] for r in rows], [r[3] for r in rows], [r[4] for r in rows])
    known = sorted(range(150), key=lambda k: spark.range(1).select(F.xxhash64(F.lit(k).cast("long"))).first()[0])

    def sums(one, two):
        out, moved = None, 0
        for k in range(150, 300):
            p, q = (1 / (1 + math.exp(-min(max(float(v.weights[v.bins(x[k : k + 1])].sum() + v.weights[-1]), -30), 30))) for v, x in ((one, feats), (two, meta)))
            part = []
            for view, x, mine, other in ((one, feats, p, q), (two, meta, q, p)):
                g, h = np.zeros(len(view.weights)), np.zeros(len(view.weights))
                if sure := other >= cotraining.CONFIDENT or other <= 1 - cotraining.CONFIDENT:
                    for i in [*view.bins(x[k : k + 1])[0].tolist(), len(g) - 1]:
                        g[i] += (other > 0.5) - mine
                        h[i] += 0.25
                    moved += 1
                part += [[float(sure)], g, h]
            out = np.concatenate(part) if out is None else out + np.concatenate(part)
        assert moved > 0
        return out

    plain = cotraining.cotrained(feats[known], meta[known], np.array([y[k] for k in known], float), sums)
    got = {r["doc_id"]: r["score"] for r in cotraining.scored(docs, labels.filter("doc_id < 150"), label_col="y").collect()}
    assert [got[k] for k in range(300)] == pytest.approx(plain.score(feats, meta).tolist(), abs=1e-9)


def test_toxic_spans_are_learned(spark):
    docs, labels, y = labelled(spark, 600, toxic_or_not)
    text = dict(rows_of(docs))
    got = {r["doc_id"]: r for r in toxic_crf.toxicity(docs, labels, F.col("doc_id") < 400, label_col="y").collect()}
    assert sum((got[k]["score"] >= 0.7) == bool(y[k]) for k in range(400, 600)) >= 190
    spans = [text[k][s["start"] : s["end"]] for k in range(400, 600) for s in got[k]["spans"]]
    assert len(spans) > 100 and sum(s in ("rotten", "foulish", "vileness") for s in spans) >= 0.95 * len(spans)


def test_marginals_equal_enumeration():
    r = np.random.default_rng(1)
    for lens in ([1], [4, 1, 3], [2, 5]):
        n = sum(lens)
        feats, model = np.arange(n)[None] % 5, toxic_crf.Model(r.normal(size=1 << toxic_crf.BITS), r.normal(size=(2, 2)), r.normal(size=2), np.zeros(4))
        first = np.zeros(n, bool)
        first[np.cumsum([0, *lens[:-1]])] = True
        got, want, at = toxic_crf.marginals(feats, first, model), [], 0
        for size in lens:
            score = model.weights[feats[0, at : at + size]]
            mass = np.zeros((size, 2))
            for path in np.ndindex(*[2] * size):
                p = math.exp(model.start[path[0]] + sum(model.trans[a, b] for a, b in zip(path, path[1:])) + sum(s * t for s, t in zip(score, path)))
                for k, t in enumerate(path):
                    mass[k, t] += p
            want += (mass[:, 1] / mass.sum(axis=1)).tolist()
            at += size
        assert got == pytest.approx(want)


def test_awkward_rows_are_scored(spark, docs):
    none = spark.createDataFrame([(None, 1, 1), (100, None, None)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxic_crf.toxicity(docs, none).collect()} == {0.0}
    out = cotraining.scored(docs, none, score_col="_quality")
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == docs.count() and {r["_quality"] for r in out.collect()} == {1.0}


# ------------------------------------------------------------------------------- empty


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    for out in (
        packing.pack_documents(empty), chosen_path.near_duplicates(empty), chosen_path.deduplicated(empty), chunk_dedup.repeats(empty), decontaminate.contaminated(empty, items), decontaminate.without_contaminated(empty, items),
        licenses.scan(empty), merkle.edited_fingerprints(empty), kneser_ney.scored(empty), pii.extract(empty), pii.redacted(empty), toxic_crf.toxicity(empty, labels), cotraining.scored(empty, labels),
    ):
        assert out.count() == 0


def test_digest_of_text_bytes_views():
    column = pa.array(["skip", "ab", None, "", "é"]).slice(1)
    raw, at = _shared.text_bytes(column)
    assert raw.tobytes().decode() == "abé" and at.tolist() == [0, 2, 2, 2, 4]
    assert hashlib.md5(raw.tobytes()).hexdigest() == hashlib.md5("abé".encode()).hexdigest()
