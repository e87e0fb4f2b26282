import pytest

from varak.llm import pii

CASES = [
    ("Язма: a.b+kitap@mail.kalam.invalid, рәхмәт.", [("email", "a.b+kitap@mail.kalam.invalid")]),
    ("x(at)mail(dot)kalam(dot)invalid", [("email", "x(at)mail(dot)kalam(dot)invalid")]),
    ("(pkg@1.48.0 версиясе)", []),
    ("Телефон: +7 (855) 068-36-22.", [("phone", "+7 (855) 068-36-22")]),
    ("[8 347 029 78 12] (847) 080-67-87 8(917)094.53.68", [("phone", "8 347 029 78 12"), ("phone", "(847) 080-67-87"), ("phone", "8(917)094.53.68")]),
    ("(шифр 83838901437) (заказ 7497442841) (ISBN 978-5-9603-586-7)", []),
    ("Паспорт мәгълүматы 00 29 125955; ИНН 008352218541; 765-505-923 80", [("id_number", "00 29 125955"), ("id_number", "008352218541"), ("id_number", "765-505-923 80")]),
    ("Карта 4111 1111 1111 1111, IBAN GB82 WEST 1234 5698 7654 32", [("id_number", "4111 1111 1111 1111"), ("id_number", "GB82 WEST 1234 5698 7654 32")]),
    ("яши (099182, Алтынкамыш авылы, Каен\nурамы, 75).", [("address", "099182, Алтынкамыш авылы, Каен\nурамы, 75")]),
    ("kept at 48/144 Spring St.. In", [("address", "48/144 Spring St.")]),
    ("Проживает: ул. Мостовая, д. 42, кв. 157.", [("address", "ул. Мостовая, д. 42, кв. 157")]),
    ("Бу хатны Гохубутев Фәрит Салаватович тапшырган. Әлфия килде.", [("person", "Гохубутев Фәрит Салаватович")]),
    ("со слов: Р. Тирушовоев. Снова слова. by Rekarenev Yu.F.. Ансамбль «Алтын Чишмә»", [("person", "Р. Тирушовоев"), ("person", "Rekarenev Yu.F.")]),
    ("СРЕДИ ВОПРОСОВ ПАВЕЛ ДОФАТИПАЕВ", [("person", "ПАВЕЛ ДОФАТИПАЕВ")]),
    ("Это Пушкин Александр Сергеевич.", [("person", "Пушкин Александр Сергеевич")]), ("писал Достоевский Ф. М. тогда", [("person", "Достоевский Ф. М.")]),
    ("said John Smith again", [("person", "John Smith")]), ("from +44 20 7946 0958 today", [("phone", "+44 20 7946 0958")]), ("SSN 123-45-6789", [("id_number", "123-45-6789")]),
    ("Пушкин. Большой Берлин. New York. +12 345", []), ("between 123-45-6789 and", []),
    ("", []), (None, []),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_spans(text, want):
    assert [(k, text[a:b]) for k, a, b in pii.spans(text)] == want


def test_checks():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")
    assert pii.tax_valid("500100732259") and pii.insurance_valid("11223344595")


def test_table(spark):
    df = spark.createDataFrame([(1, "a@b.test 😀 a@b.test", 0), (1, None, 0), (2, "", 1), (3, "x " * 50000 + "a@b.test", 2)], "doc_id bigint, text string, start_pos int")
    assert sorted(map(tuple, pii.find(df).collect())) == [(1, "email", 0, 8), (1, "email", 11, 19), (3, "email", 100000, 100008)]
    assert sorted((r.doc_id, r.text is None, (r.text or "")[:20]) for r in pii.masked(df).where("doc_id < 3").collect()) == [(1, False, "[EMAIL] 😀 [EMAIL]"), (1, True, ""), (2, False, "")]
    assert pii.find(df.limit(0)).count() == 0
