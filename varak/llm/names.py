"""Spellings of one person or publisher, by noisy-channel attribution.

Each spelling is parsed into a family name (or the core of a publisher's name), given name, patronymic and initials, in
a notation that is the same for Cyrillic and Latin. Frequent spellings are candidate canonical forms. A variant goes to
the candidate of the greatest posterior: the prior is the candidate's frequency, the likelihood that of the typing
error, abbreviation, nickname or missing part that leads from the candidate to the variant.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varak.operators.packed import author_values
from varak.sources.tables import written

#: Chance of a typing error in a name, against which the frequency of a candidate is weighed.
TYPO = 0.05
#: Names so short are mostly one error away from another real name, which costs so much of the posterior's logarithm.
SHORT, SHORT_COST = 4, 3.5

#: Notations of one sound, first the Cyrillic letters, then Latin letters and pairs (fixed values).
_CYR = dict(zip("абвгдеёжзийклмнопрстуфхцчшщыэюяәөүҗңһғҡҙҫ", "a b v g d e e j z i y k l m n o p r s t u f h q c w w y e ü ä a o u j n h g k z s".split())) | {"ъ": "", "ь": ""}
_LAT = [("shch", "w"), ("yu", "ü"), ("ya", "ä"), ("zh", "j"), ("kh", "h"), ("ts", "q"), ("ch", "c"), ("sh", "w")]
_TAT = [("ç", "ch"), ("ş", "sh"), ("ñ", "n"), ("ı", "y"), ("ä", "a"), ("ö", "o"), ("ü", "u"), ("ğ", "g"), ("x", "kh"), ("w", "v"), ("â", "a")]
_LOOKS = str.maketrans("aceopxyABCEHKMOPTXY", "асеорхуАВСЕНКМОРТХУ")
_TITLE = re.compile(r"^(?:(?:акад|проф|док|доц|prof|dr|acad)\.?\s+)+", re.I)
_FAMILY = re.compile(r"[eou]va?$")
_OTHER_FAMILY = re.compile(r"(?:[iy]n|sk[iy]y?|ska[yä])a?$")
_PATRONYMIC = re.compile(r"(?:ovi[cq]|evi[cq]|ovna|evna|i[cq]na|uly|kyzy|ugly)$")
#: Endings that shorten a given name, and short names that don't begin like the full one (fixed values).
_NICK = re.compile(r"(?:ik|uk|ük|uw|ka|kay|ay|i|u|a|ä)$")
_SHORT_NAMES = {
    "саша": "александр александра", "шура": "александр александра", "паша": "павел", "володя": "владимир", "вова": "владимир",
    "дима": "дмитрий", "митя": "дмитрий", "женя": "евгений евгения", "катя": "екатерина", "таня": "татьяна", "ваня": "иван",
    "лена": "елена", "маша": "мария", "коля": "николай", "лёша": "алексей", "юра": "юрий", "миша": "михаил", "аня": "анна",
    "наташа": "наталья", "света": "светлана", "серёжа": "сергей", "гриша": "григорий", "костя": "константин", "петя": "пётр",
}
_PUB_WORDS = re.compile(r"нәшрияты|нәшрият|нәшр\.?|китап|издательство|изд-во|изд\.|publishing|publishers?|press|ооо|зао|оао|[«»\"“”„]", re.I)
_SHORT = re.compile(r"^\S+\s*\((\w+?)(?:нәшр|нашр|изд|näşr|nashr)\.?\)$", re.I)


def sound(word: str) -> str:
    """The common notation of a word; look-alike letters of the other script are put right first."""
    cyr = sum("Ѐ" <= c <= "ӿ" for c in word)
    if cyr and any(c.isascii() and c.isalpha() for c in word):
        word = word.translate(_LOOKS)
    w = word.lower()
    if cyr:
        return "".join(_CYR.get(c, c if c.isalnum() else "") for c in w)
    tatar = any(c in "çşñıäöüğ" for c in w)
    if tatar:
        w = re.sub("c", "zh", w)
        for a, b in _TAT:
            w = w.replace(a, b)
    for a, b in _LAT:
        w = w.replace(a, b)
    return "".join(c for c in w if c.isalnum())


_SHORT_SOUNDS = {sound(k): {sound(x) for x in v.split()} for k, v in _SHORT_NAMES.items()}


def nickname(x: str, y: str) -> bool:
    """Whether x is a short or pet form of the given name y."""
    if y in _SHORT_SOUNDS.get(x, ()):
        return True
    stem = _NICK.sub("", x)
    return 2 <= len(stem) < len(x) + 1 and len(x) <= len(y) + 3 and y.startswith(stem) and x != stem or (len(x) > 2 and y.startswith(x) and len(y) - len(x) <= 2)


def parse_person(form: str) -> dict | None:
    """``family, given, cut, first, patronymic, second``; None when there is no family name."""
    text = _TITLE.sub("", form.strip())
    parts = [t for t in re.split(r"[\s,]+|(?<=\.)(?=\w)", text) if t.strip(".")]
    words, initials, cut = [], [], None
    for t in parts:
        bare = t.rstrip(".")
        if len(bare) == 1 or t.endswith(".") and bare.lower() in ("yu", "ya", "sh", "ch", "zh", "kh", "ts"):
            initials.append(sound(bare)[:1])
        elif len(bare) == 2 and bare.isupper() and bare.isalpha() and len(parts) > 1:
            initials += [sound(c)[:1] for c in bare]
        elif t.endswith("."):
            cut = sound(bare)
        else:
            words.append(sound(bare))
    words = [w for w in words if w]
    if not words:
        return None
    family = next((w for w in words if _FAMILY.search(w) and not _PATRONYMIC.search(w)), None)
    if family is None and len(words) > 1:
        family = next((w for w in words if _OTHER_FAMILY.search(w) and len(w) > 6 and not _PATRONYMIC.search(w)), None)
    if family is None:
        rest = [w for w in words if not _PATRONYMIC.search(w)]
        family = max(rest or words, key=len)
    words.remove(family)
    patronymic = next((w for w in words if _PATRONYMIC.search(w)), None)
    if patronymic:
        words.remove(patronymic)
    given = words[0] if words else None
    first = given[0] if given else cut[0] if cut else initials[0] if initials else None
    rest = initials if given or cut else initials[1:]
    second = patronymic[0] if patronymic else rest[0] if rest else None
    return {"family": family, "given": given, "cut": cut, "first": first, "patronymic": patronymic, "second": second}


def parse_publisher(form: str) -> dict | None:
    """The core of a publisher's name as ``family``; of an abbreviated one its letters as ``cut``."""
    text = form.strip()
    if m := _SHORT.match(text):
        return {"family": "", "given": None, "cut": sound(m.group(1)), "first": None, "patronymic": None, "second": None}
    text = re.sub(r"\([^)]*\)\s*$", "", text)
    text = re.sub(r"^[^:«\"]{2,40}:\s*", "", text)
    core = sound(re.sub(r"[\s-]+", "", _PUB_WORDS.sub(" ", text)))
    return {"family": core, "given": None, "cut": None, "first": None, "patronymic": None, "second": None} if core else None


def near(a: str, b: str) -> bool:
    """Whether one insertion, deletion, replacement or swap of neighbours, or nothing, leads from a to b."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    s, t = (a, b) if len(a) < len(b) else (b, a)
    return s[i:] == t[i + 1 :]


def given_score(form: dict, given: str | None, first: str | None) -> float | None:
    """Logarithm of the likelihood of a form's given part for a candidate; None when they contradict."""
    if form["first"] is None:
        return -1.5
    if given is None:
        return -0.5 if first in (None, form["first"]) else None
    if form["given"]:
        g = form["given"]
        if g == given:
            return 0.0
        if nickname(g, given) or nickname(given, g):
            return -2.0
        if len(g) > 3 and near(g, given):
            return -3.0
        return None
    if form["cut"]:
        return -1.0 if given.startswith(form["cut"]) else None
    return -0.7 if given[0] == form["first"] else None


def patronymic_score(form: dict, patronymic: str | None, second: str | None) -> float | None:
    if form["second"] is None or second is None:
        return -0.7
    if form["patronymic"] and patronymic:
        return 0.0 if form["patronymic"] == patronymic else -3.0 if near(form["patronymic"], patronymic) else None
    return -0.3 if form["second"] == second else None


def resolve(forms: list[dict]) -> list[int]:
    """Entity number of each form of one family name; ``n`` is a form's frequency.

    Forms that say most are taken first, the frequent ones before the rare ones; each joins the candidate of the
    greatest posterior or, when it contradicts all, becomes a candidate itself.
    """

    def rank(k: int) -> tuple:
        f = forms[k]
        told = 4 * bool(f["given"] and f["second"]) + 3 * bool(f["first"] and f["second"]) + 2 * bool(f["given"]) + bool(f["first"])
        return -told, -f["n"], f["given"] or "", f["patronymic"] or "", f["second"] or "", f["cut"] or "", f["first"] or ""

    index = _Candidates()
    out = [0] * len(forms)
    for k in sorted(range(len(forms)), key=rank):
        f = forms[k]
        best: tuple[float, int] | None = None
        for e in index.of(f):
            c = index.entities[e]
            g, p = given_score(f, c["given"], c["first"]), patronymic_score(f, c["patronymic"], c["second"])
            if g is None or p is None:
                continue
            score = math.log(c["n"] + 1) + g + p
            if best is None or score > best[0] + 1e-9 or score > best[0] - 1e-9 and e < best[1]:
                best = score, e
        out[k] = index.take(f, None if best is None else best[1])
    return out


class _Candidates:
    """Entities of one family name by given name, so that a form meets only those that its given part can stand for.

    A hot family name has many entities; without the index every form would be compared with each of them.
    """

    def __init__(self) -> None:
        self.entities: list[dict] = []
        self.by_given: dict[str, list[int]] = {}
        self.without: dict[str | None, list[int]] = {}  # entities without a given name, by initial
        self.givens: list[str] = []
        self.fits: dict[tuple, tuple[int, list[str]]] = {}  # how many given names were judged, and those that fit

    def of(self, f: dict) -> Iterator[int]:
        if f["first"] is None:
            yield from range(len(self.entities))
            return
        key = f["given"], f["cut"], f["first"]
        seen, fit = self.fits.get(key, (0, []))
        for g in self.givens[seen:]:
            if given_score(f, g, None) is not None:
                fit.append(g)
        self.fits[key] = len(self.givens), fit
        for g in fit:
            yield from self.by_given[g]
        for first in {None, f["first"]}:
            yield from self.without.get(first, ())

    def take(self, f: dict, e: int | None) -> int:
        """Puts a form to entity ``e``, or makes it one; what the entity lacks it gets from the form."""
        if e is None:
            e = len(self.entities)
            self.entities.append(dict(f))
            self._place(e)
            return e
        c = self.entities[e]
        c["n"] += f["n"]
        before = c["given"], c["first"]
        for x in ("given", "patronymic", "first", "second"):
            c[x] = c[x] or f[x]
        if before[0] is None and (c["given"], c["first"]) != before:
            self.without[before[1]].remove(e)
            self._place(e)
        return e

    def _place(self, e: int) -> None:
        c = self.entities[e]
        if c["given"] is None:
            self.without.setdefault(c["first"], []).append(e)
            return
        if c["given"] not in self.by_given:
            self.by_given[c["given"]] = []
            self.givens.append(c["given"])
        self.by_given[c["given"]].append(e)


_PARSED = "kind string, name_id bigint, name_form string, family string, given string, cut string, first string, patronymic string, second string"


def parsed(names: DataFrame, kind: str) -> DataFrame:
    parse = parse_person if kind == "person" else parse_publisher

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in _PARSED.split(", ")]
        for pdf in batches:
            rows = []
            for i, form in zip(pdf["name_id"], pdf["name_form"]):
                if (p := parse(form)) is not None:
                    rows.append((kind, i, form, p["family"], p["given"], p["cut"], p["first"], p["patronymic"], p["second"]))
            yield pd.DataFrame(rows, columns=columns)

    return names.select("name_id", "name_form").where("name_id is not null and trim(name_form) <> ''").mapInPandas(run, _PARSED)


def frequencies(catalog: DataFrame) -> DataFrame:
    """How often each spelling stands in the catalogue: ``kind, name_form, n``."""
    people = catalog.select(F.explode(author_values(F.col("author"))).alias("name_form")).select(F.lit("person").alias("kind"), "name_form")
    houses = catalog.select(F.lit("publisher").alias("kind"), F.col("publisher").alias("name_form")).where("name_form is not null")
    return people.unionByName(houses).groupBy("kind", "name_form").agg(F.count("*").alias("n"))


def entities(authors: DataFrame, publishers: DataFrame, catalog: DataFrame) -> DataFrame:
    """``kind, name_id, name_form, entity``: the entity each spelling stands for.

    Null and empty spellings give no row; spellings without a usable part stand for themselves; a repeated row keeps
    its id. Work is spread by family name; inside one, equal parses are put together first, so the rows of a hot name
    are never gathered, only its distinct parses.
    """
    forms = parsed(authors, "person").unionByName(parsed(publishers, "publisher"))
    forms = forms.join(frequencies(catalog), ["kind", "name_form"], "left").withColumn("n", F.coalesce("n", F.lit(0)) + 1)
    forms = written(forms, "names")
    parts = ["given", "cut", "first", "patronymic", "second"]
    short = forms.where("kind = 'publisher' and family = ''").select("kind", "name_id", "name_form", "cut")
    families = written(forms.where("family <> ''").groupBy("kind", "family").agg(
        F.sum("n").alias("n"), F.count("*").alias("forms"), F.collect_set(F.concat_ws("", F.coalesce("first", F.lit("?")), F.coalesce("second", F.lit("?")))).alias("marks"),
    ), "name-families")
    canon = written(attach_families(families), "name-houses")
    rows = forms.where("family <> ''").join(canon, ["kind", "family"])
    profiles = rows.groupBy("kind", "house", *parts).agg(F.sum("n").alias("n"))

    columns = ["kind", "house", *parts, "n"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Houses come one after the other; one that goes on in the next batch waits for it."""
        waiting: list[tuple] = []
        for pdf in batches:
            clean = pdf[columns].astype(object).where(pdf[columns].notna(), None)
            done: list[tuple] = []
            for row in clean.itertuples(index=False, name=None):
                if waiting and waiting[-1][:2] != row[:2]:
                    done += _numbered(waiting, columns)
                    waiting = []
                waiting.append(row)
            yield pd.DataFrame(done, columns=[*columns, "entity"])
        yield pd.DataFrame(_numbered(waiting, columns), columns=[*columns, "entity"])

    schema = "kind string, house string, given string, cut string, first string, patronymic string, second string, n bigint, entity int"
    resolved = profiles.select(*columns).repartition("kind", "house").sortWithinPartitions("kind", "house").mapInPandas(run, schema).drop("n")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("kind", "house", *parts)]
    out = rows.alias("a").join(resolved.alias("b"), same).select("a.kind", "a.name_id", "a.name_form", F.concat_ws("#", "a.house", F.col("b.entity").cast("string")).alias("entity"))
    # abbreviations keep the beginnings of both halves of a name, the first with two letters at least
    cores = canon.where("kind = 'publisher'").join(families.where("kind = 'publisher'").select("family", "n"), "family").select("family", "house", F.col("n").alias("weight"), F.substring("family", 1, 2).alias("head"))
    cuts = "filter(sequence(2, greatest(2, length(cut) - 1)), i -> startswith(family, substring(cut, 1, i)) and instr(substring(family, i + 1), substring(cut, i + 1)) > 0)"
    fits = short.withColumn("head", F.substring("cut", 1, 2)).join(cores, "head").withColumn("cuts", F.expr(cuts)).where("size(cuts) > 0")
    best = fits.groupBy("kind", "name_id", "name_form").agg(F.max_by("house", F.struct(F.array_contains("cuts", 3), _tail_fit(), "weight", "family")).alias("house"))
    linked = best.select("kind", "name_id", "name_form", F.concat_ws("#", "house", F.lit("0")).alias("entity"))
    lone = short.join(linked.select("name_id"), "name_id", "left_anti").select("kind", "name_id", "name_form", F.concat_ws("#", F.lit("short"), "cut").alias("entity"))
    return out.unionByName(linked).unionByName(lone)


def _numbered(rows: list[tuple], columns: list[str]) -> list[tuple]:
    """Rows of one house with the number of their entity."""
    return [(*r, e) for r, e in zip(rows, resolve([dict(zip(columns, r)) for r in rows]))]


def _tail_fit() -> F.Column:
    """Abbreviations of the same word lengths fit best: the tail then begins the second half of the name."""
    return -F.expr("abs(length(family) - instr(substring(family, 4), substring(cut, 4)) - 3 - length(cut) + 1)")


def attach_families(families: DataFrame) -> DataFrame:
    """``kind, family, house``: each family name, or core, with the candidate canonical form it is a variant of.

    Names that are one typing error apart share a key, the name without one letter, so only these pairs are made. The
    sex ending is no typing error. A candidate counts when the given parts agree and its frequency times the chance of
    an error outweighs the variant's own frequency; names of up to ``SHORT`` letters, most of which are one error away
    from another name, need more.
    """
    keyed = families.withColumn("key", F.explode(F.concat(F.array("family"), F.transform(F.sequence(F.lit(1), F.length("family")), lambda i: F.concat(F.substring(F.col("family"), F.lit(1), i - 1), F.substring(F.col("family"), i + 1, F.length("family")))))))
    left = keyed.select("kind", "key", F.col("family").alias("v"), F.col("n").alias("vn"), F.col("forms").alias("vf"), F.col("marks").alias("vm"))
    right = keyed.select("kind", "key", F.col("family").alias("u"), F.col("n").alias("un"), F.col("forms").alias("uf"), F.col("marks").alias("um"))
    pairs = left.join(right, ["kind", "key"]).where("v <> u").where((F.col("uf") > F.col("vf")) | ((F.col("uf") == F.col("vf")) & ((F.col("un") > F.col("vn")) | ((F.col("un") == F.col("vn")) & (F.col("u") > F.col("v"))))))
    pairs = pairs.dropDuplicates(["kind", "v", "u"])

    def judge(kind: pd.Series, v: pd.Series, u: pd.Series, vf: pd.Series, uf: pd.Series, vn: pd.Series, un: pd.Series, vm: pd.Series, um: pd.Series) -> pd.Series:
        out = []
        for k, a, b, af, bf, an, bn, am, bm in zip(kind, v, u, vf, uf, vn, un, vm, um):
            ok = near(a, b) and not (k == "person" and (a + "a" == b or b + "a" == a))
            score = math.log((bf + 0.5 * bn) * TYPO * 20 + 1e-9) - math.log(0.3 * af + 0.2 * an) - SHORT_COST * (min(len(a), len(b)) <= SHORT)
            if ok and k == "person":
                ok = any(_agree(x, y) for x in am for y in bm)
            out.append(score if ok and (score > 0) else None)
        return pd.Series(out, dtype="float64")

    scored = pairs.withColumn("score", F.pandas_udf(judge, "double")("kind", "v", "u", "vf", "uf", "vn", "un", "vm", "um")).where("score is not null and not isnan(score)")
    best = scored.groupBy("kind", F.col("v").alias("family")).agg(F.max_by("u", F.struct("score", "u")).alias("house"))
    # a candidate that is itself a variant passes its variants on
    once = best.alias("a").join(best.select(F.col("kind").alias("k2"), F.col("family").alias("f2"), F.col("house").alias("h2")).alias("b"), (F.col("a.kind") == F.col("k2")) & (F.col("a.house") == F.col("f2")), "left")
    best = once.select("a.kind", "a.family", F.coalesce("h2", "a.house").alias("house"))
    return families.select("kind", "family").join(best, ["kind", "family"], "left").select("kind", "family", F.coalesce("house", "family").alias("house"))


def _agree(x: str, y: str) -> bool:
    """Whether two pairs of initials, ``?`` being unknown, can be those of one person."""
    return all(a == b or "?" in (a, b) for a, b in zip(x, y)) and (x[0] == y[0])


def found(authors: DataFrame, publishers: DataFrame, catalog: DataFrame) -> DataFrame:
    """Pairs of spellings of one entity, the smaller id first."""
    rows = written(entities(authors, publishers, catalog).select("kind", "entity", "name_id").distinct(), "entities")
    a, b = rows.withColumnRenamed("name_id", "name_id_a"), rows.withColumnRenamed("name_id", "name_id_b")
    return a.join(b, ["kind", "entity"]).where("name_id_a < name_id_b").select("name_id_a", "name_id_b")
