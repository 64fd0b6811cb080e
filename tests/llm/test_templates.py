"""Template decontamination: planted items, re-parameterised questions, slots, defined cases."""

import random

import numpy as np
import pyarrow as pa

from conftest import SF01
from watchtide.llm import templates as T

Q = "Tom has 5 apples and gives 3 km of rope to his friend Ann before the 5 apples are gone."
ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string"


def found(spark, docs, items, **kw):
    return {(r.doc_id, r.item_id): r for r in T.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **kw).collect()}


def test_canonical_words():
    value, template, doc = T.template_words(pa.array(["The 12 km road, don't. Ask Bob", None, "bob"]))
    names = {int(T._NUM): "#", int(T._UNIT): "u", int(T._NAME): "N"}
    assert [names.get(int(t), "-") for t in template] == list("-#u---N-")
    assert list(doc) == [0] * 7 + [2] and value[6] == value[7]


def test_verbatim_items_are_all_found_and_nothing_else(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    items = spark.read.parquet(f"{SF01}/benchmark.parquet")
    texts = {r.item_id: r.text for r in items.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in texts.items() if t in r.text}
    got = {(r.doc_id, r.item_id) for r in T.contaminated(docs, items).collect()}
    assert want and got == want


def test_other_numbers_and_names_are_caught_if_consistent(spark):
    docs = [(1, "intro " * 30 + Q.replace("5", "8").replace("Ann", "Sue").replace("km", "miles") + " outro" * 9),
            (2, Q.replace("5", "8", 1)), (3, "Tom has apples. " * 20), (4, Q.upper()), (5, "x " + Q + " y " + Q)]
    got = found(spark, docs, [(9, Q)])
    assert {k: v.kind for k, v in got.items()} == {(1, 9): "template", (2, 9): "exact", (5, 9): "exact"} | ({(4, 9): got[4, 9].kind} if (4, 9) in got else {})
    assert got[2, 9].covered == got[2, 9].item_words - 1  # 5 goes with 8 in one place and with 5 in another: only the 8 is not covered
    assert got[5, 9].coverage >= 0.95  # within a sentence its first word is taken for a name


def test_coverage_counts_both_halves(spark):
    words = [f"lit{i}" for i in range(40)]
    items = [(1, " ".join(words))]
    docs = [(1, " ".join(words[:20] + ["inserted"] + words[20:])), (2, " ".join(words[:15])), (3, " ".join(words[:16])), (4, " ".join(random.Random(1).sample(words, 40)))]
    got = found(spark, docs, items)
    assert {k[0]: v.covered for k, v in got.items()} == {1: 40, 3: 16}


def test_few_words_of_a_short_item_are_no_leak(spark):
    words = [f"lit{i}" for i in range(12)]
    got = found(spark, [(1, " ".join(words[:7])), (2, " ".join(words[:8]))], [(1, " ".join(words))])
    assert set(got) == {(2, 1)}


def test_case_and_punctuation_do_not_hide_an_item(spark):
    item = "Où est l'été, demanda le général à son ami. Über den Dächern von Wien regnet es, und niemand geht aus."
    forms = [item, item.upper(), item.lower(), item.title(), item.replace(",", "").replace(".", ""), item.replace(" ", " \n ")]
    got = found(spark, [(i, f"before {f} after") for i, f in enumerate(forms)], [(1, item)])
    assert {k[0] for k in got} == set(range(len(forms)))


def plain(docs, items, min_cover=T.MIN_COVER):
    """All pairs of texts of literals only: share of the item's words in common windows at one offset."""
    out = set()
    for i, a in docs:
        for j, b in items:
            x, y = a.split(), b.split()
            n = min(T.WINDOW, len(y))
            cover = {q + k for p in range(len(x) - n + 1) for q in range(len(y) - n + 1) if x[p:p + n] == y[q:q + n] for k in range(n)}
            if y and len(cover) / len(y) >= min_cover and len(cover) >= min(T.MIN_WORDS, len(y)):
                out.add((i, j))
    return out


def test_literal_texts_against_all_pairs(spark):
    rng = random.Random(4)
    vocab = [f"w{c}" for c in "abcdefghij"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 4, 6, 9, 14])))) for i in range(25)]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(60)) + " " + rng.choice(items)[1]) for i in range(40)]
    assert set(found(spark, docs, items)) == plain(docs, items)


def test_defined_cases(spark):
    items = [(1, Q), (1, Q), (2, None), (3, ""), (None, Q), (4, "7 8 9"), (5, "word")]
    docs = [(1, Q), (1, Q), (None, Q), (2, None), (3, ""), (4, "7 8 9"), (5, "pad " * 100_000 + Q)]
    got = T.contaminated(spark.createDataFrame([(*d, "x") for d in docs], DOCS + ", item_id string"), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted(((r.doc_id or 0), r.item_id) for r in got) == [(0, 1), (1, 1), (5, 1)]
    d = spark.createDataFrame([(*x, "x") for x in docs], DOCS + ", item_id string")
    kept = T.clean_documents(d, spark.createDataFrame(items, ITEMS))
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert found(spark, [], items) == {} and found(spark, docs, []) == {}


def test_bitmap_holds_every_item_window(spark):
    win = T.item_windows(spark.createDataFrame([(i, f"a{i} b{i} c d e f g h") for i in range(50)], ITEMS))
    bits, lengths = T._bitmap(win)
    assert lengths == [T.WINDOW]
    for r in win.collect():
        b = r.h & ((1 << T.FILTER_BITS) - 1)
        assert bits[b >> 3] >> (b & 7) & 1
    assert 0 < int(np.unpackbits(bits).sum()) <= win.count()


def test_other_numbers_that_become_equal_are_caught(spark):
    item = "A farmer picks 3 apples and then 5 pears from the old tree behind the house."
    got = found(spark, [(1, item.replace("3", "4").replace("5", "4")), (2, item)], [(1, item)])
    assert {k[0]: v.kind for k, v in got.items()} == {1: "template", 2: "exact"}


def test_items_of_few_literals_are_found_word_for_word(spark):
    table, names, short = "total 7 8 9 10 11 12 13 14 15 16", "met Anna Bob Carl 5 Dora 6 Emil 7", "answer 7 8 9"
    docs = [(1, f"see {table} end"), (2, f"see {table} end".replace("1", "2")), (3, f"who {names.lower()} there"), (4, f"the {short} is")]
    assert {k: v.kind for k, v in found(spark, docs, [(1, table), (2, names), (3, short)]).items()} == {(i, j): "exact" for i, j in ((1, 1), (3, 2), (4, 3))}


def test_rows_without_an_id_are_told_apart_by_their_text(spark):
    words = [f"lit{i}" for i in range(40)]
    docs = [(None, " ".join(words)), (None, "clean text of its own"), (None, " ".join(words[:12])), (None, " ".join(words[12:24])), (None, None)]
    items = spark.createDataFrame([(1, " ".join(words))], ITEMS)
    kept = T.clean_documents(spark.createDataFrame(docs, DOCS), items)
    assert sorted(r.text or "" for r in kept.collect()) == sorted(t or "" for _, t in docs[1:])


def test_every_text_of_an_item_counts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(10)) for x in "abc")
    got = T.clean_documents(spark.createDataFrame([(1, a), (2, b), (3, c), (4, "other")], DOCS), spark.createDataFrame([(1, a), (1, b), (None, c)], ITEMS))
    assert [r.doc_id for r in got.collect()] == [4]


def test_one_number_edited_of_two_equal_ones(spark):
    words = [f"lit{i}" for i in range(37)]
    item = " ".join([*words[:10], "77", *words[10:25], "77", *words[25:]])
    edited = item.replace("77", "78", 1)
    other = item.replace("77", "78")
    got = found(spark, [(1, item), (2, edited), (3, other), (4, item + " and more " + other)], [(1, item)])
    assert {k[0]: (v.kind, v.covered) for k, v in got.items()} == {1: ("exact", 39), 2: ("exact", 38), 3: ("template", 39), 4: ("exact", 39)}
    numbers = "if 3 of 9 boxes hold 4 of 7 balls then 5 of 8 hold 2 of 6"
    changed = "if 13 of 19 boxes hold 14 of 17 balls then 15 of 18 hold 12 of 16"
    torn = "if 3 of 9 boxes hold 4 of 7 balls then 5 of 8 hold 2 of 6".replace("3", "5")
    got = found(spark, [(1, numbers), (2, changed), (3, torn)], [(1, numbers)])
    assert got[1, 1].kind == "exact" and (2, 1) in got and (3, 1) in got


def test_a_passage_of_many_items_and_documents_stays_linear(spark):
    """Windows that many items share with many documents go before words are told apart."""
    shared = "please read the following text and answer it"
    rng = random.Random(3)
    items = [(i, shared + " " + " ".join(f"i{i}w{rng.randrange(10**6)}" for _ in range(30))) for i in range(60)]
    docs = [(i, shared + f" doc{i} " * 10) for i in range(60)] + [(100 + i, t) for i, t in items[:5]]
    got = found(spark, docs, items)
    assert set(got) == {(100 + i, i) for i in range(5)}
