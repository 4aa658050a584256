import random

from strata.llm.decontam import item_bytes, leaks


def distance_in(item: bytes, text: bytes) -> int:
    """Fewest edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_planted_edits_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 7)))
    items = [" ".join(word() for _ in range(rng.randint(8, 16))) for _ in range(8)]
    items += ["gloss terminus", "hugo marathons xi", "quintessential bards", "nine letters of umber granite"]  # 14 to 29 bytes
    docs = []
    for k in range(60):
        body = [word() for _ in range(60)]
        if k % 2:
            planted = list(items[k % 12])
            for _ in range(rng.randint(0, 14 if k % 12 < 8 else 3)):
                at = rng.randrange(len(planted))
                planted[at] = rng.choice(["", "x", planted[at] + "q", planted[at].upper(), planted[at] + ", "])
            body.insert(rng.randrange(60), "".join(planted))
        docs.append((k, " ".join(body)))
    found = {(r.doc_id, r.item_id): r for r in leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                                     spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    want = {}
    for k, text in docs:
        for i, item in enumerate(items):
            own = item_bytes(item).tobytes()
            edits = distance_in(own, item_bytes(text).tobytes())
            if edits <= int(0.1 * len(own)):
                want[k, i] = edits
    assert {key: r.edits for key, r in found.items()} == want
    assert any(want.values()) and 0 in want.values()


def test_spans_and_folding(spark):
    item = "Où est l'Élève: dans la grande salle, ou bien au jardin?"
    text = "Début « OÙ EST L'ÉLÈVE -- dans la grande salle ou\nbien au jardin » fin"
    (r,) = leaks(spark.createDataFrame([(9, text)], "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert (r.doc_id, r.item_id, r.edits) == (9, 1, 0) and text[r.start:r.end].startswith("OÙ EST") and text[r.start:r.end].endswith("jardin")


def test_edge_rows(spark, documents, none):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon", 1), (2, None, 1), (3, "", 1), (4, "short", 1), (None, "unseen words that match nothing", 1), (1, "alpha beta gamma delta epsilon", 2)],
                                  "item_id long, text string, doc_id long")
    rows = leaks(documents, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(1, 1)] * 2 + [(5, 1)] * 4
    assert leaks(none, items).count() == 0 and leaks(documents, items.limit(0)).count() == 0
    assert sorted((r.doc_id, r.item_id) for r in leaks(documents, items, block_items=1).collect()) == sorted((r.doc_id, r.item_id) for r in rows)


def test_very_long_text(spark):
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    text = "filler words here " * 200_000 + item + " and more" * 1000
    assert [(r.doc_id, r.edits) for r in leaks(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()] == [(1, 0)]


def test_short_items(spark):
    """The budget is that of the rate at every length: 10 to 15 bytes one edit, fewer none."""
    items = ["seven dwarfs x", "abcdefghij", "abc defg", "xyz", "", "  .. "]
    docs = ["the seven dwarts x came", "seven dwarxxs x", "zabcdefgxhijz", "an abc, Defg here", "an abc defh here", "wxyz", "wxy z"]
    found = leaks(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.edits) for r in found.collect()) == [(0, 0, 1), (2, 1, 1), (3, 2, 0), (5, 3, 0)]
