import random
import time

import pytest

from varak.llm import names

GROUPS = [
    ["Бенипукоева Фатыйма Евгениевна", "Бенипукоева Ф.Е.", "Бенипукоева ФЕ"],
    ["Бенипукоева Фатыйма Рөстәмовна", "акад. Бенипукоева Ф.Р."],
    ["Пуводошиев Җәмил Салаватович", "Пуводошиев Жамил Салаватович", "Пуводошиев Җ.С.", "Пуводошиев, Җәмил Салаватович"],
    ["Илдар Пуводошиев", "Пуводошиев Илдар", "Пуводошиев И.А.", "Илдар Пуовдошиев", "ИЛДАР ПУВОДОШИЕВ", "Ildar Puvodoshiev", "Илдарик Пуводошиев"],
    ["Мәрьям Пиропозаева", "Пиропозаева М.Ф."], ["Булат Пиропозаев"],
]
HOUSES = [["«Алтындулкын» нәшрияты", "АДН (Алтдулнәшр)", "Алтын Дулкын нәшрияты", "ООО \"Алтындулкын\"", "Ташкүлле: Алтындулкын", "Altındulkın Publishing", "Алтынудлкын нәшрияты"], ["«Алтынсандык» нәшрияты", "Издательство «Алтынсандык»"]]


def test_entities(spark):
    def rows(groups, start):
        return [(start + k, f, "clash") for k, f in enumerate(x for g in groups for x in g)]

    authors, houses = rows(GROUPS, 100), rows(HOUSES, 1)
    schema = "name_id bigint, name_form string, kind string"
    catalog = spark.createDataFrame([("; ".join(g[0] for g in GROUPS), HOUSES[0][0])], "author string, publisher string")
    a, p = (spark.createDataFrame([*x, (900 + len(x), None, ""), (950 + len(x), " ", "")], schema) for x in (authors, houses))
    got = {tuple(r) for r in names.found(a, p, catalog).collect()}
    of = {f: k for k, f, _ in authors + houses}
    want = {tuple(sorted((of[x], of[y]))) for g in GROUPS + HOUSES for x in g for y in g if x != y}
    assert got == want


def test_empty(spark):
    a = spark.createDataFrame([], "name_id bigint, name_form string")
    assert names.found(a, a, spark.createDataFrame([], "author string, publisher string")).count() == 0


@pytest.mark.parametrize(("a", "b", "want"), [("абв", "абв", True), ("абв", "авб", True), ("абв", "абгв", True), ("абв", "агв", True), ("абвг", "бавг", True), ("абвг", "багв", False), ("аб", "абвг", False)])
def test_near(a, b, want):
    assert names.near(a, b) is want


def test_notations():
    assert names.sound("Көмешкүпер") == names.sound("Kömeşküper") and names.sound("Җәмил") == names.sound("Жамил") == names.sound("Zhamil") == names.sound("Cämil")
    assert names.nickname("rinatik", "rinat") and names.nickname(names.sound("Володя"), names.sound("Владимир")) and not names.nickname("saniä", "salavat")


def test_short_names_and_heads(spark):
    schema = "name_id bigint, name_form string"
    authors = spark.createDataFrame([(1, "Воев Марат"), (2, "Ввев Марат"), (3, "Боев Марат")], schema)
    houses = spark.createDataFrame([(11, "«Илкөмеш» нәшрияты"), (12, "ИК (Илмешнәшр)")], schema)
    catalog = spark.createDataFrame([("Воев Марат", None)] * 300 + [("Боев Марат", None)] * 200, "author string, publisher string")
    assert {tuple(r) for r in names.found(authors, houses, catalog).collect()} == {(1, 2), (11, 12)}


def test_candidates_are_those_of_a_full_search(monkeypatch):
    rng = random.Random(5)
    givens = [f"{a}{b}{c}n" for a in "abcd" for b in "aeiou" for c in "lmr"]
    forms = []
    for _ in range(600):
        given, second = rng.choice(givens), rng.choice("abc")
        kind = rng.randrange(5)
        forms.append({"given": given if kind < 2 else None, "cut": given[:2] if kind == 2 else None, "first": given[0] if kind < 4 else None, "patronymic": None, "second": second if kind % 2 else None, "n": rng.randint(1, 9)})
    fast = names.resolve([dict(f) for f in forms])
    monkeypatch.setattr(names._Candidates, "of", lambda self, f: range(len(self.entities)))
    assert names.resolve([dict(f) for f in forms]) == fast


def test_hot_family_name():
    forms = [{"given": f"gi{k % 400:03}vn", "cut": None, "first": "g", "patronymic": f"{chr(97 + k // 400 % 25) * 3}{k // 400:02}ovic", "second": chr(97 + k // 400 % 25), "n": 1} for k in range(20_000)]
    began = time.time()
    assert len(set(names.resolve(forms))) > 1000 and time.time() - began < 60
