import random
import re

import pytest

from surveyscore.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for at in range(len(w) - k + 1):
                for item in windows.get(tuple(w[at:at + k]), ()):
                    hit |= set(range(at, at + k))
                    found |= {item} if item is not None else set()
                if tuple(w[at:at + k]) in windows:
                    hit |= set(range(at, at + k))
        out.append((i, len(w), len(hit), tuple(sorted(map(str, found)))))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, items string, id int"),
            spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string"))


def found(spark, docs, items, **kw):
    return dc.find_contamination(*frames(spark, docs, items), **kw).collect()


TEN = "one two three four five six seven eight nine ten"
ITEMS = [(1, TEN + " eleven"), (2, "Short ITEM"), (3, None), (4, "..."), (5, "Élan vital é 漢字 x9"), (6, TEN), (None, "no id here"), (2, "Short ITEM"),
         (10, "Two THREE four five six seven eight nine ten eleven")]
DOCS = [(1, f"Before {TEN.upper()}, after"), (2, f"{TEN} eleven twelve"), (3, "a short-item b"), (4, None), (5, ""), (6, "short items"),
        (7, "x Élan  vital, é\n漢字 X9 y"), (8, "é ÉLAN vital é 漢字 x9"), (9, "say no id HERE"), (9, "say no id HERE"), (None, "short item"),
        (11, "word " * 30000 + TEN), (12, "!!! ???"), (13, "shortitem short\x00item"), (14, "one two three four five six seven eight nine")]


@pytest.mark.parametrize("most", [dc.MAX_WINDOWS, 2])
def test_equals_brute_force(spark, most):
    got = found(spark, DOCS, ITEMS, max_windows=most)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got), key=repr) == brute(DOCS, ITEMS)


def test_spans_name_the_original_text(spark):
    rows = {r.doc_id: r for r in found(spark, DOCS, ITEMS)}
    texts = dict(DOCS)
    cut = lambda i: [texts[i][s.start:s.end] for s in rows[i].spans]
    assert cut(1) == [TEN.upper()] and cut(3) == ["short-item"] and cut(7) == ["Élan  vital, é\n漢字 X9"]
    assert cut(13) == ["short\x00item"] and cut(6) == []


def test_random_texts(spark):
    rnd = random.Random(2)
    text = lambda n: " ".join(rnd.choice(["a", "b", "C", "é", "d.", "-"]) for _ in range(n))
    items = [(i, text(rnd.randint(0, 6))) for i in range(12)]
    docs = [(i, text(rnd.randint(0, 40))) for i in range(80)]
    got = found(spark, docs, items, size=4, max_windows=5)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got), key=repr) == brute(docs, items, 4)


def test_a_passage_of_many_items_travels_as_one_number(spark):
    """Items that share a passage: its windows carry one set, members are listed once."""
    items = [(i, f"{TEN} eleven twelve" + (" thirteen" if i % 2 else "")) for i in range(200)] + [(None, TEN), (500, "alone"), (None, "unnamed")]
    docs, benchmark = frames(spark, [(1, f"x {TEN} eleven twelve y"), (1, f"{TEN} eleven twelve thirteen"), (None, "ALONE " + TEN), (3, "unnamed")], items)
    found, members = dc.windows(benchmark, "item_id", "text", 10)
    assert found.count() == 6 and found.select("items").distinct().count() == 4  # all, odd ones, one, none
    assert members.count() == 200 + 100 + 1
    got = sorted((len(r["items"]), r.n_hit) for r in dc.find_contamination(docs, benchmark).collect())
    assert got == [(0, 1), (200, 12), (200, 13), (201, 11)]
    plain = dc.find_contamination(docs, benchmark, with_items=False)
    assert "items" not in plain.columns and sorted(r.n_hit for r in plain.collect()) == [1, 11, 12, 13]


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == []
    assert [(r.n_words, r.n_hit, r["items"]) for r in found(spark, [(1, "a b")], [])] == [(2, 0, [])]
