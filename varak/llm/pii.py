"""Personal information in free text: spans, and texts with typed placeholders.

Regular expressions propose spans; checksum validators (Luhn for cards, mod-97 for IBANs, the control digits of tax and
insurance numbers) raise a proposal's score, the words just before it raise or lower it, and a span counts from
``THRESHOLD`` on. Texts are read whole, in Arrow batches, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 1.0
KINDS = ("email", "phone", "id_number", "address", "person")

UP, LOW = "A-ZА-ЯЁӘӨҮҖҢҺҒҠҘҪÄÖÜÇĞŞİÑ", "a-zа-яёәөүҗңһғҡҙҫäöüçğşıñ"
S = r"[ \t\u00a0]*\n?[ \t\u00a0]*"  # blanks with at most one line feed
S1 = r"(?:[ \t\u00a0]+\n?[ \t\u00a0]*|\n[ \t\u00a0]*)"
NAME = rf"[{UP}][{UP}{LOW}’'-]+"

#: Given names that tell a name from a capitalised first word of a sentence (fixed values).
GIVEN = """
азат айгөл айгуль айдар айрат айсылу александр александра алексей алексей алсу альбина альфия анвар андрей анна артур
булат вадим венера виктор владимир габдулла галия гөлнара гульнара гүзәл дания данил дина динә динара дмитрий евгений
екатерина елена жамил җәмил заһир зариф зилә зөлфия зөфәр зуфар зульфия иван илдар ильдар илнур ирина камил ленар ләйлә
лейла лилия людмила мария марат мәрьям марьям мөхәммәт мухаммат надия наил наталья николай нурия олег ольга павел рамил
раил рәшит резеда ренат ринат роза рөстәм рустам рустем салават сания светлана сергей софья татьяна тимур фәрит фарит
фатыйма фатима хәсән хасан чулпан шамил эльвира эдуард юлия юныс юнус әлфия әнвәр
anvar azat aysılu aysylu aleksandr alsu alfiya bulat venera vladimir gabdulla golnara gulnara dina dmitriy evgeniy
ekaterina jamil zhamil zolfiya zofar ildar kamil lenar laylya layla maryam mokhammat muhammat nail nuriya olga pavel
rezeda rinat rostam rustam salavat saniya tatyana timur farit fatyyma fatima khasan chulpan shamil yunys yunus äzat älfiya
änwär cämil hasan xäsän möxämmät zöfär zölfiä fatıyma läylä märyam röstäm wenera wladimir färit yunıs çulpan şamil
""".split()
_FOLD = str.maketrans("әөүҗңһё", "аоужнхе")
GIVEN_SET = frozenset(x.translate(_FOLD) for x in GIVEN)
TOWN_WORDS = frozenset("шәһәре авылы ҡалаһы ауылы şähäre awılı урамы ур uramı ur улица".split())

EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9._+-]*[A-Za-z0-9_])?(?: ?@ ?| ?\[at\] ?| ?\(at\) ?)[A-Za-z0-9-]+(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?)[A-Za-z0-9-]+)*(?:\.| ?\(dot\) ?| ?\[dot\] ?)[A-Za-z]{2,}(?![\w-]|\.[A-Za-z0-9])")
AT = re.compile(r"@|\[at\]|\(at\)")
NUMBER = re.compile(r"(?<![\w№+./-])(?:\+?\d|\(\d{3}\))[\d()№./\s-]{6,26}\d(?!\d)")
PHONE = re.compile(rf"(?:\+7|8)?[ \n-]?(?:\(\d{{3}}\)|\d{{3}})[ \n.-]?{S}\d{{3}}[ \n.-]?\d\d[ \n.-]?\d\d(?![\d-])")
PASSPORT = re.compile(rf"(?:\d{{4}}{S1}№{S}\d{{6}}|\d\d{S1}\d\d{S1}\d{{6}})(?!\d)")
ABROAD = re.compile(r"\+(?!7[\d\s(-])\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?![\d-])")
SOCIAL = re.compile(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d-])")
INSURANCE = re.compile(rf"\d{{3}}-\d{{3}}-\d{{3}}{S1}\d\d(?!\d)")
TAX = re.compile(r"\d{12}(?!\d)")
CARD = re.compile(r"\d{4}(?:[ -]?\d{4}){3}(?!\d)")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)")
#: Words before a number that isn't personal, and words before one that is.
AGAINST = re.compile(r"(?:шифр|инв\.?|заказ|isbn|удк|ббк|гост|тираж|том|кн\.|рәсем|рис\.|версия\w*|https?://\S*|order|№)\s*№?\s*$", re.I)
FOR_ID = re.compile(r"(?:паспорт\w*|pasport\w*|passport\w*|мәгълүматы|мәғълүматы|mäglümatı|номер\w*|nomer\w*|number|инн|снилс|ssn|social security(?: number)?|tax no\.?|свидетельство|under|серия и номер|карточк\w*|card|ул|ul)[\s:—–-]*(?:no\.?|№)?\s*$", re.I)
FOR_PHONE = re.compile(r"(?:телефон\w*|тел\.|telefon|phone|шалтырат\w*|şaltırat\w*|звонить|номеру|call)[\s:—–-]*(?:\S+\s){0,2}$", re.I)

_POST = rf"(?:\d{{6}},{S})?"
_TOWN = rf"(?:(?:(?:г|с|д|пос|п)\.|город|село|деревня){S}{NAME},{S}|{NAME}{S1}(?:шәһәре|авылы|ҡалаһы|ауылы|şähäre|awılı),{S})?"
_HOUSE = r"\d+(?:[-–/]\d+)?"
ADDRESS = re.compile(
    rf"(?<![\w])(?:{_POST}{_TOWN}(?:"
    rf"(?:ул\.|улица|пер\.|переулок|пр\.|проспект){S}{NAME},{S}(?:(?:д\.|дом){S})?{_HOUSE}(?:,{S}(?:кв\.|квартира){S}\d+)?"
    rf"|{NAME}{S1}(?:улица|переулок|проспект),{S}(?:(?:д\.|дом){S})?{_HOUSE}(?:,{S}(?:кв\.|квартира){S}\d+)?"
    rf"|{NAME}{S1}(?:урамы|ур\.|uramı|ur\.|тыкрыгы),{S}{_HOUSE}(?:-?(?:н[чс][еы]|nç[eı]))?(?:{S1}(?:йорт|йорто|yort)(?!\w))?(?:,{S}\d+{S1}(?:фатир|fatir)(?!\w))?"
    rf")|{_HOUSE}{S1}{NAME}{S1}(?:St\.|Street|Lane|Road|Rd\.|Avenue|Ave\.)(?:,{S}Apt\.?{S}\d+)?(?:,{S}{NAME}(?:,{S}\d{{6}})?(?=[\s.,;:)\]>!?]|$))?)"
)
ADDRESS_HINT = re.compile(r"ур(?:амы|\.)|ул(?:\.|ица)|ur(?:amı|\.)|St\.|Street|Lane|Road|Avenue|тыкрыгы|переулок|пер\.|пр\.|проспект")

SURNAME = re.compile(rf"(?<![\w-])[{UP}](?:[{LOW}A-Za-z’'-]+?(?:[еёоу]в|[eou]v)[аa]?|[{UP}]{{2,}}(?:[ЕЁОУ]В|[EOU]V)[АA]?)(?![\w-])")
#: Other endings of family names, which need a patronymic, two initials or a known given name beside them (fixed values).
OTHER = r"(?:[иы]н|[сц]к(?:ий|ой)|енко|[аяу]нко|[уюч]ук|ян|дзе|швили|ин|sk[iy]y?|tsky|enko|yan|dze|shvili)"
FEMALE = r"(?:[иы]на|[сц]кая|ina|skaya)"
WIDE = re.compile(rf"(?<![\w-])[{UP}][{LOW}]+?(?:{OTHER}|{FEMALE})(?![\w-])")
#: Given names of English (fixed values); a capitalised word after one is a family name.
ENGLISH = frozenset("""
alice andrew anne anthony barbara brian carol charles christopher daniel david deborah donald dorothy edward elizabeth emily
emma george helen henry jack james jane jennifer jessica john joseph karen kenneth kevin laura linda margaret mark martin mary
matthew michael nancy oliver patricia paul peter richard robert ronald ruth sandra sarah sharon steven susan thomas william
""".split())
PAIR = re.compile(r"(?<![\w.-])(?:(?:Mr|Mrs|Ms|Dr|Prof)\.?[ \u00a0]+)?(?P<given>[A-Z][a-z]+)(?:[ \u00a0]+[A-Z]\.)?[ \u00a0]+(?P<name>(?:Mc|Mac|O['’])?[A-Z][a-z]+(?:-[A-Z][a-z]+)?)(?![\w-])")
PATRONYMIC = r"(?:ович|евич|ич|овна|евна|ична|ovich|evich|ovna|evna|ОВИЧ|ЕВИЧ|ОВНА|ЕВНА)"
INITIAL = rf"(?:[{UP}]|Yu|Ya|Sh|Ch|Zh|Kh|Ts)\."
AFTER = re.compile(rf",?{S1}(?:(?P<ini>{INITIAL}(?:{S}{INITIAL})?)|(?P<bare>[{UP}]{{2}})(?![\w.])|(?P<given>{NAME})(?P<pat>{S1}[{UP}][{UP}{LOW}A-Za-z]+{PATRONYMIC}(?!\w))?(?![\w]))")
BEFORE = re.compile(rf"(?<!\w)(?:(?P<ini>{INITIAL}(?:{S}{INITIAL})?){S}|(?P<given>[{UP}][{UP}{LOW}A-Za-z’'-]+\.?)(?P<pat>{S1}[{UP}][{UP}{LOW}A-Za-z]+{PATRONYMIC})?{S1})$")
SENTENCE_START = re.compile(r"(?:^|[.!?:»\"“)\]—]\s*|\n\s*\n\s*|#\s*)$")


def luhn(digits: str) -> bool:
    """Luhn's check digit."""
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(digits)))) % 10 == 0


def mod97(iban: str) -> bool:
    """The check of an IBAN: the number with its head moved to the end leaves 1 modulo 97."""
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def tax_valid(d: str) -> bool:
    """Control digits of a twelve-digit tax number."""
    n = [*map(int, d)]
    first = sum(a * b for a, b in zip(n, (7, 2, 4, 10, 3, 5, 9, 4, 6, 8))) % 11 % 10
    return first == n[10] and sum(a * b for a, b in zip(n, (3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8))) % 11 % 10 == n[11]


def insurance_valid(d: str) -> bool:
    """Control number of an eleven-digit insurance number."""
    return sum(int(c) * k for c, k in zip(d, range(9, 0, -1))) % 101 % 100 == int(d[9:])


def _numbers(text: str) -> Iterator[tuple[float, str, int, int]]:
    for m in NUMBER.finditer(text):
        at, end = m.start(), m.end()
        while at < end:
            before = text[max(0, at - 28) : at]
            for rule, kind, score, valid in (
                (PASSPORT, "id_number", 1.0, None), (INSURANCE, "id_number", 1.0, insurance_valid), (CARD, "id_number", 0.4, luhn),
                (TAX, "id_number", 0.8, tax_valid), (SOCIAL, "id_number", 0.6, None), (PHONE, "phone", 0.4, None), (ABROAD, "phone", 0.4, None),
            ):
                if (x := rule.match(text, at)) is None or x.end() > end:
                    continue
                s = x.group()
                if kind == "phone":
                    score += 0.8 * s.startswith(("+", "8")) + 0.8 * s.startswith("(") - 2 * (not 8 <= sum(c.isdigit() for c in s) <= 15)
                    score += 0.5 * bool(FOR_PHONE.search(before))
                else:
                    score += 0.5 * bool(FOR_ID.search(before)) + 0.8 * bool(valid and valid(re.sub(r"\D", "", s)))
                if AGAINST.search(before):
                    score -= 2
                if score >= THRESHOLD:
                    yield score, kind, at, x.end()
                    at = x.end()
                    break
            else:
                if (nxt := re.compile(r"[^\d+(]+[\d+(]").search(text, at, end)) is None:
                    break
                at = nxt.end() - 1


def _person(text: str, m: re.Match, addresses: list[tuple[int, int]]) -> tuple[float, str, int, int] | None:
    """The name around a surname; its score tells how sure the given part is."""
    best: tuple[float, str, int, int] | None = None
    shout = m.group().isupper()
    if (a := AFTER.match(text, m.end())) is not None:
        given = a.group("given")
        if a.group("ini"):
            best = 1.4, "person", m.start(), a.end()
        elif a.group("bare") and not shout:
            best = 1.1, "person", m.start(), a.end()
        elif given and (a.group("pat") or _given(given)) and not given.lower() in TOWN_WORDS:
            best = 1.3 + 0.3 * bool(a.group("pat")), "person", m.start(), a.end()
    head = text[max(0, m.start() - 48) : m.start()]
    if (b := BEFORE.search(head)) is not None:
        start, given = m.start() - len(head) + b.start(), b.group("given")
        if b.group("ini"):
            score = 1.35
        elif _given(given) or b.group("pat"):
            score = 1.5
        elif shout or given[:-1].isupper() or SENTENCE_START.search(head[: b.start()]):
            score = 0.0
        else:
            score = 1.0
        if score >= THRESHOLD and (best is None or score > best[0]):
            best = score, "person", start, m.end()
    return best


def _wide(text: str, m: re.Match) -> tuple[float, str, int, int] | None:
    """A name round a word with a less telling ending: only with a patronymic, two initials or a known given name."""
    if (a := AFTER.match(text, m.end())) is not None:
        two = a.group("ini") and a.group("ini").count(".") > 1
        if two or a.group("pat") or a.group("given") and _given(a.group("given")):
            return 1.2, "person", m.start(), a.end()
    head = text[max(0, m.start() - 48) : m.start()]
    if (b := BEFORE.search(head)) is not None:
        two = b.group("ini") and b.group("ini").count(".") > 1
        if two or b.group("pat") or b.group("given") and _given(b.group("given")):
            return 1.2, "person", m.start() - len(head) + b.start(), m.end()
    return None


def _given(word: str) -> bool:
    """A known given name in any of its notations, or with a dot the beginning of one."""
    bare = word.rstrip(".").lower().translate(_FOLD)
    return bare in GIVEN_SET or (word.endswith(".") and len(bare) > 1 and any(g.startswith(bare) for g in GIVEN_SET))


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in order, without overlaps; empty for null and empty texts."""
    if not text:
        return []
    found: list[tuple[float, str, int, int]] = []
    if AT.search(text):
        found += [(2.0, "email", *m.span()) for m in EMAIL.finditer(text)]
    addresses = []
    if ADDRESS_HINT.search(text):
        for m in ADDRESS.finditer(text):
            found.append((1.8, "address", *m.span()))
            addresses.append(m.span())
    found += _numbers(text)
    found += [(1.0 + mod97(m.group()), "id_number", *m.span()) for m in IBAN.finditer(text) if mod97(m.group())]
    found += [x for m in SURNAME.finditer(text) if (x := _person(text, m, addresses)) is not None]
    found += [x for m in WIDE.finditer(text) if (x := _wide(text, m)) is not None]
    found += [(1.1, "person", m.start("given"), m.end()) for m in PAIR.finditer(text) if m.group("given").lower() in ENGLISH]
    found.sort(key=lambda x: (-x[0], x[2], x[2] - x[3]))
    taken: list[tuple[str, int, int]] = []
    for score, kind, a, b in found:
        if score >= THRESHOLD and all(b <= x or a >= y for _, x, y in taken):
            taken.append((kind, a, b))
    return sorted(taken, key=lambda x: x[1])


def mask(text: str | None) -> str | None:
    """The text with ``[KIND]`` in place of each span; null stays null."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b in spans(text):
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def find(df: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """One row per mention: key, ``pii_kind, start_pos, end_pos`` (characters from 0, end excluded).

    Null and empty texts give no row, repeated rows give repeated mentions, an empty table gives an empty result; other
    columns are not read. Positions count code points, as Python strings do.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *x) for k, t in zip(pdf["k"], pdf["t"]) for x in spans(t)]
            yield pd.DataFrame(rows, columns=["k", "pii_kind", "start_pos", "end_pos"])

    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(key).alias("k"), F.col(column).alias("t")).where("t is not null and t <> ''")
    return source.mapInPandas(run, f"k {kind}, pii_kind string, start_pos int, end_pos int").withColumnRenamed("k", key)


def masked(df: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Key and text with typed placeholders; null texts stay null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(mask, na_action="ignore")

    return df.select(key, run(F.col(column)).alias(column))
