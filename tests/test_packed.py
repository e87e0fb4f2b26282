from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from varak.operators import packed


def split(spark, column, *texts):
    fn = packed.author_values if column == "author" else packed.isbn_values
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.orderBy("i").select(fn(F.col("t")).alias("v")).collect()]


def test_authors(spark):
    given_, want = zip(
        ("Азат Гарувефиев, Илдар Фивосенев", ["Азат Гарувефиев", "Илдар Фивосенев"]),
        ("Гарувефиев, А. Б.; Фивосенев И.Б.", ["Гарувефиев, А. Б.", "Фивосенев И.Б."]),
        ("Гарувефиев, Азат Илдарович,Фивосенев Илдар", ["Гарувефиев, Азат Илдарович", "Фивосенев Илдар"]),
        ('"Гарувефиев, А. Б.", "проф. Фивосенев И."', ["Гарувефиев, А. Б.", "проф. Фивосенев И."]),
        ('["A B", "C D"]', ["A B", "C D"]),
        ("«A B», «C D»", ["A B", "C D"]),
        ("A B и C D һәм E F & G H and I J и др.", ["A B", "C D", "E F", "G H", "I J"]),
        ("A B // C D|E F\nG H,,I J", ["A B", "C D", "E F", "G H", "I J"]),
        ("A B һ.б.", ["A B"]),
        (" Unknown ", []), ("", []), (None, []), (",;", []), ('"A B', ["A B"]),
    )
    assert split(spark, "author", *given_) == list(want)


def test_isbns(spark):
    given_, want = zip(
        ("978-5-91886-001-2, 5 93613 087 x", ["9785918860012", "593613087X"]),
        ("ISBN-13: 9785441365796 (1 том); ISBN 5-215-69262-9 (в пер.)", ["9785441365796", "5215692629"]),
        ("9785830699655 978-5-51654-038-7", ["9785830699655", "9785516540387"]),
        ('"978 5 30418 868 5"', ["9785304188685"]),
        ("12345", []), ("нет", []), (None, []),
    )
    assert split(spark, "isbn", *given_) == list(want)


def test_rows(spark):
    df = spark.createDataFrame([("a", "5936130870; 9785918860012", "A B", "x"), ("a", "5936130870", None, "y")], "md5 string, isbn string, author string, item string")
    assert sorted(map(tuple, packed.split_rows(df).collect())) == [("a", "author", 1, "A B"), ("a", "isbn", 1, "5936130870"), ("a", "isbn", 1, "5936130870"), ("a", "isbn", 2, "9785918860012")]
    assert packed.split_rows(df.limit(0)).count() == 0


def test_isbn13(spark):
    df = spark.createDataFrame([("0306406152",), ("9780306406157",)], "c string")
    assert {r[0] for r in df.select(packed.isbn13(F.col("c"))).collect()} == {"9780306406157"}


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sampled_from(["Азат Гар", "Ә. Б. Фив", "Фив Илдар Азатович", "Фив, И. А."]), min_size=1, max_size=5), st.sampled_from(["; ", ";", " | ", "\n", ",, "]))
def test_round_trip(spark, names, delimiter):
    assert split(spark, "author", delimiter.join(names)) == [names]


def test_long_field(spark):
    assert len(split(spark, "author", "; ".join(["A B"] * 3000))[0]) == 3000
