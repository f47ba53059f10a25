"""Personal data and secrets, replaced by keyed surrogates of the same kind. DataFrame functions only."""

from __future__ import annotations

import json
import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import Scratch, utf8

# Given names by gender and script. They are both what is looked for and what stands in.
GIVEN = {
    ("female", "latin"): "Alice Amelia Anna Carla Carmen Charlotte Chloe Clara Elena Elizabeth Emily Emma Eva Greta Hannah "
    "Helen Ingrid Isabel Jane Julia Karin Laura Lena Linda Lucia Margaret Maria Marie Martha Mary Nina Olivia Paula Rachel "
    "Rosa Sarah Sofia Sophie Susan Teresa",
    ("male", "latin"): "Adam Albert Alexander Andrew Anton Benjamin Bernard Carlos Charles Daniel David Diego Edward Felix "
    "Francis Frank Georg George Hans Henry Hugo James Jean John Jonas Joseph Karl Louis Lukas Manuel Martin Michael Oliver "
    "Oscar Paul Peter Robert Thomas Victor William",
    ("female", "cyrillic"): "Анна Вера Галина Дарья Екатерина Елена Ирина Ксения Лариса Людмила Мария Надежда Наталья Ольга "
    "Полина Светлана Софья Татьяна Юлия Яна",
    ("male", "cyrillic"): "Алексей Андрей Антон Борис Виктор Владимир Григорий Дмитрий Иван Игорь Кирилл Максим Михаил Николай "
    "Олег Павел Пётр Роман Сергей Юрий",
}
# Words that stand before a surname.
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Mme Mlle Señor Señora Monsieur Madame Господин Госпожа господин госпожа".split()
# Surnames are made of these syllables, first, middle and last.
SYLLABLES = {
    "latin": (
        "Bar Ber Cal Dar Del Fal Gar Gol Hal Hol Kar Kel Lan Lor Mal Mar Mor Nor Pel Ral Ros Sal Sel Tal Tor Val Ver Wal Wen Zel".split(),
        "a be da de di e ga ge i ka la le li ma me mi na ne ni o ra re ri sa se ta te ti va ve".split(),
        "bert brook dorf field ford gren hart holm land lin man mann mar mont nard ner rand ron sen son ston ström ter ton vall ville wald well wick zer".split(),
    ),
    "cyrillic": (
        "Бар Бел Вол Гор Дол Жар Зар Кар Кол Лар Мал Мор Нов Пав Рог Сав Сол Тар Фад Чер".split(),
        "а ба ва га да е ка ла ма на о ра са та ча".split(),
        "ев енко ин ич ко ков ник нов ов овский рин тов ук хин шин".split(),
    ),
}
NAMES = {n: key for key, names in GIVEN.items() for n in names.split()}
CAPITAL = r"\p{Lu}[\p{L}\p{M}]+(?:[-'’]\p{Lu}[\p{L}\p{M}]+)*+"
SECRET_WORD = r"(?i:password|passwd|passphrase|pwd|secret|token|api[_-]?key)"
# White space and digits of any script.
BLANK, DIGIT = r"\p{IsWhite_Space}", r"\p{Nd}"
SECRET_START = rf"{SECRET_WORD}[\"']?{BLANK}{{0,3}}[=:]{BLANK}{{0,3}}[\"']?"
OCTET = rf"(?:25[0-5]|2[0-4]{DIGIT}|1?{DIGIT}?{DIGIT}|[{DIGIT}&&[^0-9]]{{3}})"
END = r"(?![\p{L}\p{N}_])"
OTHER_DIGITS = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd")
ZERO = "0" + "".join(c for c in OTHER_DIGITS if unicodedata.digit(c) == 0)
# A further digit of a phone number, which begins neither an IP address nor a time.
GAP = rf"(?:[.-]| (?!(?:{OCTET}\.){{3}}{OCTET}(?!\.?{DIGIT})|{DIGIT}{{1,2}}:{DIGIT}))?"
STEP, WIDE = rf"(?:{GAP}{DIGIT})", rf"(?:\)?{GAP}\(?{DIGIT})"
AREA, FIRST = rf"\({DIGIT}{{2,4}}\)[ .-]?", rf"[{DIGIT}&&[^{ZERO}]]"
# + or 00 and the first digit of a country code, but no signed fraction.
ABROAD = rf"(?:\+(?!{DIGIT}\.{DIGIT}{{1,9}}(?![.-]?{DIGIT}))|(?<!{DIGIT}[./:,-])[{ZERO}]{{2}}){FIRST}"
# A zero and another digit that begin neither a date nor, after other digits, further thousands.
TRUNK = (
    rf"(?<!{DIGIT}[./:,-])(?!{DIGIT}{{2}}[./-]{DIGIT}{{1,2}}[./-](?:{DIGIT}{{4}}|{DIGIT}{{2}})(?![./-]?{DIGIT})|{DIGIT}{{2}}[./](?:19|20){DIGIT}{{2}}(?!{DIGIT}))"
    rf"(?!(?<={DIGIT} ){DIGIT}{{3}}(?: {DIGIT}{{3}})+{END})[{ZERO}]{FIRST}"
)
# Where a row of digits is too long for one number, and may be several, the usual groups come before the longest.
PHONES = (
    rf"\+1[ .-]?(?:\({DIGIT}{{3}}\)|{DIGIT}{{3}})[ .-]?{DIGIT}{{3}}[ .-]?{DIGIT}{{4}}{END}",
    rf"{ABROAD}{WIDE}{{7,14}}+(?!{WIDE}){END}",
    rf"\([{ZERO}]{FIRST}{DIGIT}{{0,4}}\){STEP}{{5,9}}+(?!{STEP}){END}",
    rf"(?:\+{DIGIT}{{1,3}}[ .-]?(?:{AREA}|{DIGIT}{{2,4}}[ .-])|{AREA}){DIGIT}{{3,4}}[ .-]?{DIGIT}{{3,4}}{END}",
    rf"{ABROAD}{WIDE}{{7,14}}{END}",
    rf"\([{ZERO}]{FIRST}{DIGIT}{{0,4}}\){STEP}{{5,9}}{END}",
    rf"{TRUNK}{STEP}{{7,10}}+(?!{STEP}){END}",
    rf"{TRUNK}{DIGIT}{{0,2}}[ .-]{DIGIT}{{3,4}}[ .-]?{DIGIT}{{3,4}}{END}",
    rf"{TRUNK}{DIGIT}{{1,3}}/{DIGIT}{{3}}{STEP}{{2,7}}{END}",
    rf"{TRUNK}{STEP}{{7,10}}{END}",
    rf"{DIGIT}{{3}}[ .-]{DIGIT}{{3}}[ .-]{DIGIT}{{4}}{END}",
)
# What each kind looks like. Possessive quantifiers keep the work linear in the length of a text.
PATTERNS = {
    "secret": rf"{SECRET_START}(?=[^{BLANK}\"',;]{{0,200}}?{DIGIT})[^{BLANK}\"',;]{{6,}}+",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "key": rf"(?:(?:AKIA|ASIA)[A-Z0-9]{{16}}|gh[pousr]_[A-Za-z0-9]{{36}}|sk-[A-Za-z0-9]{{20,}}+){END}",
    "hex": rf"(?:[0-9a-f]{{32,}}+|[0-9A-F]{{32,}}+){END}",
    "iban": rf"(?=[A-Z]{{2}}{DIGIT})[A-Z]{{2}}{DIGIT}{{2}}(?: ?[A-Z{DIGIT}]{{4}}){{3,7}}(?: ?[A-Z{DIGIT}]{{1,3}})?{END}",
    "ssn": rf"(?<!-){DIGIT}{{3}}-{DIGIT}{{2}}-{DIGIT}{{4}}(?![\p{{L}}\p{{N}}_-])",
    "card": rf"(?<![.+-]){DIGIT}(?:[ -]?{DIGIT}){{12,18}}(?![\p{{L}}\p{{N}}_]|-{DIGIT})",
    "ip": rf"(?<!\.)(?:{OCTET}\.){{3}}{OCTET}(?![\p{{L}}\p{{N}}_]|\.{DIGIT})",
    "phone": rf"(?<!\+)(?:{'|'.join(PHONES)})",
}
# A given name before another capitalised word, or a capitalised word after a given name or title. Cheap
# looks at the neighbouring word come before the lists.
NAME = (
    rf"(?=\p{{Lu}}[\p{{L}}\p{{M}}])(?:(?=\p{{L}}{{2,12}}+ \p{{Lu}})(?:{'|'.join(sorted(NAMES))})(?= {CAPITAL})"
    rf"|(?<=(?:\p{{Lu}}\p{{L}}{{1,11}}|{'|'.join(t for t in TITLES if t.islower())})\.? )(?<=(?<!\p{{L}})(?:{'|'.join(sorted([*NAMES, *TITLES]))})\.? ){CAPITAL})"
)
WORDS = ("email", "key", "hex", "iban")
NUMBERS = ("ssn", "card", "ip", "phone")
# The word before a secret may end an identifier, as in accessToken. Nothing else begins within a run of
# letters and digits; numbers are tried where one can begin.
ANY = (
    rf"(?=[APSTapst]){PATTERNS['secret']}"
    rf"|(?<![A-Za-z{DIGIT}])(?:{'|'.join(PATTERNS[k] for k in WORDS)}"
    rf"|(?=[{DIGIT}(+])(?:{'|'.join(PATTERNS[k] for k in NUMBERS)})|{NAME})"
)
KEY_START = "^(AKIA|ASIA|gh[a-z]_|sk-)"


def kind_of(mention: Column) -> Column:
    """The kind of a mention, given that it matched one of the patterns."""
    given = constant({n: f"given:{g}:{s}" for n, (g, s) in NAMES.items()}, "map<string,string>")
    out = F.coalesce(
        F.try_element_at(given, mention),
        F.when(mention.rlike(r"[Ѐ-ӿ]"), "surname:cyrillic").otherwise("surname:latin"),
    )
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def value_of(kind: Column, mention: Column) -> Column:
    """What a mention means, whatever its spelling: mentions of one kind and value are one entity.

    E-mail addresses in lower case; card, phone, account and social security
    numbers without blanks and marks, phones without a leading 00 and country code 1; secrets
    without the word before them; names in lower case. Digits of numbers count as the ASCII digits they stand for.
    """
    plain = F.translate(mention, OTHER_DIGITS, "".join(str(unicodedata.digit(c)) for c in OTHER_DIGITS))
    digits = F.regexp_replace(plain, "[^0-9]", "")
    dialled = F.regexp_replace(digits, "^00", "")
    return (
        F.when(kind == "email", F.lower(mention))
        .when(kind == "secret", F.regexp_extract(mention, f"(?s)^{SECRET_START}(.*)$", 1))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", F.when((F.length(dialled) == 11) & dialled.startswith("1"), F.substring(dialled, 2, 10)).otherwise(dialled))
        .when(kind == "iban", F.replace(plain, F.lit(" "), F.lit("")))
        .when(kind == "ip", plain)
        .when(kind.startswith("given") | kind.startswith("surname"), F.lower(mention))
        .otherwise(mention)
    )


# -- surrogates ----------------------------------------------------------------


def stream_of(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """Hex digits that depend on the key, the entity and the attempt: two for each character of the value, and 128 more."""
    blocks = F.sequence(F.lit(0), F.ceil(F.length(value) / 32).cast("int") + 1)
    seed = F.concat_ws("\u0001", F.lit(key), kind, attempt.cast("string"), value)
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat(seed, F.lit("\u0001"), b.cast("string")).cast("binary"), 256)), "")


def number(stream: Column, at, digits: int = 2) -> Column:
    """The hex digits from ``at`` on as a number."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.substring(stream, at + 1, F.lit(digits)), 16, 10).cast("long")


def pick(letters: str | Column, n: Column) -> Column:
    letters = F.lit(letters) if isinstance(letters, str) else letters
    return F.substring(letters, (n % F.length(letters)).cast("int") + 1, F.lit(1))


def shaped(value: Column, stream: Column, lower: Column) -> Column:
    """Each digit replaced by an ASCII digit, each letter by a letter of its case and script; other characters stay."""
    cyrillic = "абвгдежзиклмнопрстуфхцчшэюя"

    def replaced(c: Column, i: Column) -> Column:
        n = number(stream, i * 2)
        return (
            F.when(c.rlike(r"^\p{Nd}$"), pick("0123456789", n))
            .when(c.rlike("^[a-z]$"), pick(lower, n))
            .when(c.rlike("^[A-Z]$"), F.upper(pick(lower, n)))
            .when(c.rlike(r"^[а-џ]$"), pick(cyrillic, n))
            .when(c.rlike(r"^[Ѐ-Я]$"), F.upper(pick(cyrillic, n)))
            .when(c.rlike(r"^\p{Lu}$"), F.upper(pick(lower, n)))
            .when(c.rlike(r"^\p{L}$"), pick(lower, n))
            .otherwise(c)
        )

    chars = F.filter(F.split(value, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, replaced), "")


def luhn_digit(digits: Column) -> Column:
    """The check digit that belongs after ``digits``."""
    chars = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))

    def part(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return d - F.when(d > 9, 9).otherwise(0)

    total = F.aggregate(F.transform(chars, part), F.lit(0), lambda a, x: a + x)
    return ((10 - total % 10) % 10).cast("string")


def iban_of(country: Column, account: Column) -> Column:
    """An account number with the check digits of its country and account."""
    chars = F.filter(F.split(F.concat(account, country, F.lit("00")), ""), lambda c: c != "")
    place = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(chars, F.lit(0), lambda a, c: (a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + place(c)) % 97)
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), account)


def with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (kind, value, attempt) with the stand-in of each: same kind, length and make-up.

    Mail domains end in the reserved ``.example``; card numbers keep their first
    digit and pass the Luhn check; phones keep a leading zero; account numbers keep their country and have
    right check digits; addresses stay addresses; names keep gender and script.
    """
    kind, value, attempt, stream, base, wild = map(F.col, ("kind", "value", "attempt", "stream", "base", "wild"))
    size = F.length(value)
    kept = F.length(F.regexp_extract(value, KEY_START, 1))
    octets = [number(stream, 8 * i, 4) % (223 if i == 0 else 256) + (1 if i == 0 else 0) for i in range(4)]
    card = F.concat(F.substring(value, 1, 1), F.substring(wild, F.lit(2), size - 2))
    steps = {
        "stream": stream_of(key, kind, value, attempt),
        "base": stream_of(key, kind, value, F.lit(0)),
    }
    letters = F.when(value.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "abcdef").otherwise("abcdefghijklmnopqrstuvwxyz")
    parts = entities.withColumns(steps).withColumn("letters", letters)
    parts = parts.withColumn("wild", shaped(value, stream, F.col("letters"))).withColumn("card", card)
    # Names try the pool from a keyed place on, and after that get second parts.
    lists = "map<string,array<string>>"
    pool = F.try_element_at(constant({":".join(("given", *k)): v.split() for k, v in GIVEN.items()}, lists), kind)
    own = element(pool, number(base, 0, 8) + attempt)
    first = F.when(attempt < F.size(pool), own).otherwise(F.concat(own, F.lit("-"), element(pool, number(stream, 8, 8))))
    script = F.try_element_at(F.split(kind, ":"), F.lit(2))
    begin, middle, end = (constant({k: v[i] for k, v in SYLLABLES.items()}, lists) for i in range(3))
    inner = [element(F.try_element_at(middle, script), number(stream, 16 + 8 * i, 8)) for i in range(3)]
    last = F.concat(
        element(F.try_element_at(begin, script), number(stream, 0, 8)),
        inner[0],
        F.when(attempt >= 2, inner[1]).otherwise(""),
        F.when(attempt >= 4, inner[2]).otherwise(""),
        element(F.try_element_at(end, script), number(stream, 8, 8)),
    )
    out = (
        F.when(kind == "email", F.regexp_replace(wild, r"\.[^.@]*$", ".example"))
        .when(kind == "key", F.concat(F.substring(value, F.lit(1), kept), F.substring(wild, kept + 1, size)))
        .when(kind == "card", F.concat("card", luhn_digit(F.col("card"))))
        .when(kind == "iban", iban_of(F.substring(value, 1, 2), F.substring(wild, F.lit(5), size)))
        .when(kind == "ip", F.concat_ws(".", *[o.cast("string") for o in octets]))
        .when((kind == "phone") & value.startswith("0") & (size >= 8), F.concat(F.lit("0"), pick("23456789", number(stream, 0)), F.substring(wild, F.lit(3), size)))
        .when(kind == "phone", F.concat(pick("23456789", number(stream, 0)), F.substring(wild, F.lit(2), size)))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(wild, F.lit(2), size)))
        .when(kind.startswith("given"), first)
        .when(kind.startswith("surname"), last)
        .otherwise(wild)
    )
    return parts.select("kind", "value", "attempt", out.alias("surrogate"))


def constant(value: dict, kind: str) -> Column:
    """One literal, where nested constructors would be code for every entry."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def element(words: Column, n: Column) -> Column:
    return F.try_element_at(words, (n % F.size(words)).cast("int") + 1)


def written_as(kind: Column, mention: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's own format: with its blanks, marks, country code, word before it or capitals."""
    chars = F.filter(F.split(mention, ""), lambda c: c != "")
    # Letters and digits beyond the value's, such as a country code, stand first and stay.
    extra = F.length(F.regexp_replace(mention, rf"[^A-Za-z{DIGIT}]", "")) - F.length(value)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

    def put(a: Column, c: Column) -> Column:
        counts = c.rlike(rf"^[A-Za-z{DIGIT}]$")
        new = F.when(counts & (a["n"] >= extra), F.substring(surrogate, a["n"] - extra + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(a["out"], new).alias("out"), (a["n"] + F.when(counts, 1).otherwise(0)).alias("n"))

    spread = F.aggregate(chars, start, put)["out"]
    name = kind.startswith("given") | kind.startswith("surname")
    return (
        F.when(kind.isin("phone", "card", "iban", "ssn"), spread)
        .when(kind == "secret", F.concat(F.substring(mention, F.lit(1), F.length(mention) - F.length(value)), surrogate))
        .when(name & (F.upper(mention) == mention), F.upper(surrogate))
        .otherwise(surrogate)
    )


def distinct_surrogates(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, value, surrogate): a surrogate of its own for each of ``entities`` (kind, value; distinct).

    Where two entities of a kind drew the same surrogate, or one drew what is
    itself an entity, all but the first try again with the next attempt, until none is left.
    """
    kind, value = F.col("kind"), F.col("value")
    name = kind.startswith("given") | kind.startswith("surname")
    drawn = entities.withColumn("attempt", F.lit(0))
    known = entities.select(F.col("kind").alias("k"), value.alias("taken"))
    while True:
        drawn = scratch.write(with_surrogates(drawn, key))
        first = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "value")).alias("first"))
        judged = drawn.join(first, ["kind", "surrogate"]).join(
            known, (kind == F.col("k")) & (F.lower("surrogate") == F.lower("taken")), "left"
        )
        # Names are few; one of them may stand for another, but not for itself.
        clash = F.when(name, F.lower("surrogate") == value).otherwise(F.col("taken").isNotNull())
        again = (F.struct("attempt", "value") != F.col("first")) | clash
        judged = scratch.write(judged.select("kind", "value", "attempt", "surrogate", again.alias("again")).distinct())
        scratch.drop(drawn)
        if not judged.where("again").limit(1).count():
            return judged.select("kind", "value", "surrogate")
        drawn = judged.select("kind", "value", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))


# -- texts ---------------------------------------------------------------------


def replace_pii(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with every detected entity in ``text`` replaced by its surrogate.

    One entity has one surrogate wherever it occurs in the table, two entities
    have two, and no surrogate is an entity of the table. The same ``key`` gives
    the same surrogates again for the same entities of a table without clashes.
    ``count`` names a column for the number of mentions replaced. Texts without
    mentions, null and empty texts stay as they are and are not moved; rows and
    further columns stay. An empty table gives an empty result. Surrogates of names
    keep gender and script; a surname alone and after a given name is the same entity.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    names = docs.columns
    body = F.col(text)
    has = F.coalesce(body.rlike(ANY), F.lit(False))
    digest = F.md5(utf8(body))
    mentions = F.array_distinct(F.regexp_extract_all(body, F.lit(ANY), F.lit(0)))
    # Copies of a text are looked at once from here on.
    found = docs.where(has).select(digest.alias("digest"), mentions.alias("m")).groupBy("digest").agg(F.first("m").alias("m"))
    found = scratch.write(found.select("digest", F.explode("m").alias("mention")))
    kinds = found.select("mention").distinct().withColumn("kind", kind_of(F.col("mention")))
    kinds = scratch.write(kinds.withColumn("value", value_of(F.col("kind"), F.col("mention"))))
    entities = distinct_surrogates(kinds.select("kind", "value").distinct(), key, scratch)
    written = written_as(F.col("kind"), F.col("mention"), F.col("value"), F.col("surrogate"))
    table = scratch.write(kinds.join(entities, ["kind", "value"]).select("mention", written.alias("new")))
    pairs = found.join(table, "mention").groupBy("digest")
    maps = pairs.agg(F.map_from_entries(F.collect_list(F.struct("mention", "new"))).alias("__new"))
    maps = maps.withColumnRenamed("digest", "__digest")
    gaps = F.split(body, ANY, -1)
    hits = F.regexp_extract_all(body, F.lit(ANY), F.lit(0))
    new = F.transform(hits, lambda h: F.try_element_at(F.col("__new"), h))
    result = F.concat(
        F.element_at(gaps, 1),
        F.array_join(F.zip_with(new, F.slice(gaps, F.lit(2), F.size(gaps)), lambda a, b: F.concat(a, b)), ""),
    )
    mended = docs.where(has).withColumn("__digest", digest).join(maps, "__digest")
    extra = [] if count is None else [F.size(hits).cast("long").alias(count)]
    none = [] if count is None else [F.lit(0).cast("long").alias(count)]
    kept = [c for c in names if c != count]
    changed = mended.select(*[result.alias(c) if c == text else F.col(c) for c in kept], *extra)
    return docs.where(~has).select(*kept, *none).unionByName(changed)
