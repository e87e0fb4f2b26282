import random

from varak.llm import leaks

WORDS = [f"сүз{i}" for i in range(4000)]
DOC = "doc_id bigint, text string, item_id int"


def brute(doc, item):
    """Longest run of the item's words in order inside any window of the item's length plus four."""
    d, i = leaks.words(doc), leaks.words(item)
    best = 0
    for s in range(0, max(1, len(d) - len(i) // 2), 2):
        w = d[s : s + len(i) + 4]
        row = [0] * (len(w) + 1)
        for x in i:
            above = row[:]
            for k, y in enumerate(w, 1):
                row[k] = above[k - 1] + 1 if x == y else max(above[k], row[k - 1])
        best = max(best, row[-1])
    return best >= len(i) / 2


def test_against_brute_force(spark):
    rng = random.Random(3)
    items = [(k, " ".join(rng.choices(WORDS, k=rng.randint(30, 80)))) for k in range(8)]
    docs = []
    for d in range(24):
        words = rng.choices(WORDS, k=rng.choice([20, 100, 400]))
        if d % 2:
            item = items[rng.randrange(8)][1].split()
            n = int(len(item) * rng.choice([0.25, 0.6, 0.8, 1.0]))
            at = rng.randrange(len(item) - n + 1)
            piece = [w if rng.random() > 0.06 else "үзгә" for w in item[at : at + n]]
            cut = rng.randrange(len(words))
            words[cut:cut] = [w.upper() + "," for w in piece]
        docs.append((d, " ".join(words), 0))
    got = {tuple(r) for r in leaks.found(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id bigint, item_text string")).collect()}
    want = {(d, k) for d, t, _ in docs for k, i in items if brute(t, i)}
    assert got == want and want


def test_edges(spark):
    text = " ".join(WORDS[:40])
    items = spark.createDataFrame([(1, text), (2, text), (3, None), (4, ""), (5, "бер")], "item_id bigint, item_text string")
    docs = spark.createDataFrame([(1, "# " + text.replace("сүз7 ", "сүз-\n7 "), 0), (1, text, 0), (2, None, 0), (3, "", 0), (4, "бер", 0), (5, text.replace(" ", "\n") + " x" * 30000, 0)], DOC)
    assert sorted(map(tuple, leaks.found(docs, items).collect())) == [(1, 1), (1, 1), (1, 2), (1, 2), (5, 1), (5, 2)]
    assert leaks.found(docs, items.limit(0)).count() == 0 and leaks.found(docs.limit(0), items).count() == 0


def test_blocks_drop_nothing(spark, monkeypatch):
    items = spark.createDataFrame([(k, " ".join(WORDS[k * 40 : k * 40 + 40])) for k in range(9)], "item_id bigint, item_text string")
    docs = spark.createDataFrame([(k, " ".join(WORDS[k * 40 : k * 40 + 40]), 0) for k in range(9)], DOC)
    monkeypatch.setattr(leaks, "BLOCK_ITEMS", 3)
    assert sorted(map(tuple, leaks.found(docs, items).collect())) == [(k, k) for k in range(9)]


def test_a_stretch_on_a_thinner_diagonal():
    item = list(range(40))
    decoy = [*item[:19], *range(900, 960)]
    thin = [*item[:7], 801, *item[7:14], 802, *item[14:21]]
    assert leaks._stretch(item, decoy * 3 + thin, 20) and not leaks._stretch(item, decoy * 3, 20)
