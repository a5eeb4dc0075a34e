"""Personal data replaced by keyed surrogates of the same kind. Column expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import written

TITLES = "Mrs|Mr|Ms|Miss|Dr|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor|Sra|Sr"
#: A title and those after it ('Frau Dr.'), and a name, which may be joined by hyphens.
TITLED, PERSON = rf"(?:{TITLES})\.?(?: (?:Dr|Prof)\.?)*", r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)*"
#: Kinds of entities in order of precedence, with their patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "name": rf"\b{TITLED} {PERSON}(?: {PERSON})?",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9A-Fa-f]*[0-9])[0-9A-Fa-f]{32,}(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])(?!\.[0-9])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    # before telephone numbers, which would take three of the four groups of a card and leave the last one
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])|\+[0-9]{8,15}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these holds no entity; far cheaper to look for. Single digits stand in addresses and secrets only.
HINT = rf"[0-9]{{2}}|@|[0-9]\.[0-9]|[0-9A-Fa-f]{{32}}|\b(?:{TITLES})\b"
#: Given names by script and gender, and surnames that are the same for both.
NAMES = {
    "f": "Ada Berta Clara Dora Elena Flora Greta Hanna Irene Julia Karla Laura Maria Nora Olga Paula Rosa Sara Teresa Vera".split(),
    "m": "Adam Bruno Carlos David Emil Felix Georg Hugo Ivan Jakob Karl Leon Marco Nils Oskar Pablo Rolf Simon Tomas Victor".split(),
    "Cyrillic f": "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Клара Лариса Мария Нина Ольга Полина Раиса Софья Тамара Ульяна Фаина Юлия".split(),
    "Cyrillic m": "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Николай Олег Павел Роман Семён Тимур Фёдор Эдуард Юрий".split(),
    "Greek f": "Αγγελική Άννα Βασιλική Γεωργία Δήμητρα Ειρήνη Ελένη Ζωή Ιωάννα Κατερίνα Λυδία Μαρία Νίκη Ουρανία Παρασκευή Ρένα Σοφία Τασία Φωτεινή Χριστίνα".split(),
    "Greek m": "Άγγελος Αλέξανδρος Βασίλης Γιώργος Δημήτρης Ευάγγελος Ηλίας Θανάσης Ιωάννης Κώστας Λάμπρος Μιχάλης Νίκος Ορέστης Πέτρος Ραφαήλ Σταύρος Τάσος Φώτης Χρήστος".split(),
}
SURNAMES = {
    "": "Adler Becker Castro Duran Engel Fuchs Garcia Hoffer Iriarte Jansen Keller Lorenz Moreno Nadal Ortega Peters Quirin Roland Salas Torres".split(),
    "Cyrillic": "Бондаренко Василенко Гончаренко Демченко Еременко Захарченко Иваненко Коваленко Лысенко Марченко Назаренко Остапенко Петренко Романенко Сидоренко Тимошенко Федоренко Харченко Шевченко Юрченко".split(),
    "Greek": "Αθανασίου Αναγνώστου Αντωνίου Βασιλείου Γεωργίου Δημητρίου Ευαγγέλου Ζαχαρίου Θεοδώρου Ιωάννου Κωνσταντίνου Μιχαήλ Νικολάου Οικονόμου Παύλου Σταύρου Στεφάνου Τριανταφύλλου Φιλίππου Χριστοδούλου".split(),
}
FEMALE = r"^(?:Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra)\b"
MALE = r"^(?:Mr|Herr|Monsieur|Señor|Sr)\b"
#: Where the title says nothing, a given name is female by this list or its ending.
FEMALE_GIVEN = [*NAMES["f"], *NAMES["Cyrillic f"], *NAMES["Greek f"]] + (
    "Agnes Alice Anne Ashley Astrid Beatrice Birgit Carmen Caroline Catherine Charlotte Chloe Claire Denise Dolores Doris Edith Elisabeth Elizabeth Emily Esther"
    " Eve Florence Frances Gabrielle Grace Heather Heidi Helen Ines Ingrid Isabel Isabelle Jane Janet Jennifer Jessica Joan Joyce Judith Julie Karen Kate Katherine"
    " Katrin Kerstin Kimberly Louise Lucy Madeleine Margaret Marie Marion Martine Mary Megan Mercedes Michelle Monique Nancy Natalie Nicole Pilar Rachel Raquel"
    " Rebecca Renate Rosario Rose Ruth Sarah Sharon Simone Sophie Stephanie Susan Susanne Sylvie Ursula Valerie Yvonne Zoe"
).split()
MALE_GIVEN = [*NAMES["m"], *NAMES["Cyrillic m"], *NAMES["Greek m"]] + "Andrea Elia Garcia Joshua Luca Luka Mustafa Nicola Nikita Sascha Никита Илья Фома Лука Кузьма Савва".split()
FEMALE_ENDING = "[aáаяαάηήωώ]$"
#: Country codes of telephone numbers.
COUNTRY = r"^(\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})|)"
#: Octets that say that an address is private, and stay.
PRIVATE = r"^(10\.|127\.|169\.254\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|)"
PARTED = "[^0-9A-Za-z+]"  # blanks and signs of a number, which its notations differ in
ROUNDS = 40  # of new draws; two surrogates still equal after them raise an error


def _matches(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def kind_of(value: Column) -> Column:
    """The first kind whose pattern the whole value matches."""
    return F.coalesce(*[F.when(value.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()], F.lit("card"))


def _digits(name: Column, length: Column) -> Column:
    """A keyed stream of numbers from 0 to 255, one for each character."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(length / 32).cast("int")), lambda i: F.sha2(F.concat(name, F.lit(":"), i.cast("string")), 256))
    return F.array_join(blocks, "")


def _number(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, 2 * i + 1, F.lit(2)), 16, 10).cast("int")


def _redrawn(value: Column, stream: Column, letters: bool, hexadecimal: bool = False) -> Column:
    """Every digit becomes a digit, every letter (if wanted) one of its case; all else stays."""

    def one(c: Column, i: Column) -> Column:
        n = _number(stream, i)
        out = F.when(c.rlike("^[0-9]$"), (n % 10).cast("string"))
        if letters:
            width = 6 if hexadecimal else 26
            out = out.when(c.rlike("^[a-z]$"), F.char(97 + n % width)).when(c.rlike("^[A-Z]$"), F.char(65 + n % width))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _pick(words: Sequence[str], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), n % len(words) + 1)


def normal_form(kind: Column, value: Column) -> Column:
    """What all notations of a value share: letter case of mail and secrets, blanks and signs of numbers are left out."""
    return F.when(kind.isin("email", "secret"), F.lower(value)).when(kind.isin("card", "iban", "phone"), F.regexp_replace(value, PARTED, "")).otherwise(value)


def _gender(title: Column, given: Column) -> Column:
    known = F.when(title.rlike(FEMALE), "f").when(title.rlike(MALE), "m").when(given.isin(MALE_GIVEN), "m").when(given.isin(FEMALE_GIVEN), "f")
    return known.when(given.rlike(FEMALE_ENDING), "f").otherwise("m")


def parts_of(kind: Column, value: Column) -> Column:
    """Array of (kind, value) that are drawn each by itself: given names (with their gender) and surnames of a name, else the normal form."""
    words = F.split(F.regexp_replace(value, f"^{TITLED} ", ""), " ")
    part = lambda k, v: F.struct(k.alias("part"), v.alias("form"))
    surnames = F.transform(F.split(F.element_at(words, -1), "-"), lambda w: part(F.lit("surname"), w))
    first = F.get(words, F.lit(0))
    given = F.transform(F.split(first, "-"), lambda w: part(F.lit("given"), F.concat(_gender(value, F.regexp_extract(first, "^[^-]+", 0)), F.lit(":"), w)))
    named = F.when(F.size(words) > 1, F.concat(given, surnames)).otherwise(surnames)
    return F.when(kind == "name", named).otherwise(F.array(part(kind, normal_form(kind, value))))


def _luhn(digits: Column) -> Column:
    """Sum of the digits by Luhn's rule, every second one from the right doubled; a multiple of 10 in a valid number."""
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 1, doubled(d.cast("int"))).otherwise(d.cast("int")))
    return F.aggregate(values, F.lit(0), lambda n, d: n + d)


def _mod97(text: Column) -> Column:
    """Remainder of an account number by 97, its letters read as 10 to 35; 1 in a valid one."""
    moved = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))
    value = lambda c: F.when(c.rlike("^[0-9]$"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda n, c: (n * F.when(c.rlike("^[0-9]$"), 10).otherwise(100) + value(c)) % 97)


def _card(value: Column, drawn: Column) -> Column:
    """A card number whose check digit is right if that of the value was."""
    body = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
    check = F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(_luhn(value) % 10 == 0, F.concat(body, check)).otherwise(drawn)


def _iban(value: Column, drawn: Column) -> Column:
    """An account number whose check digits are right if those of the value were."""
    rest = F.substring(drawn, F.lit(5), F.length(drawn))
    country = F.substring(value, 1, 2)
    check = F.lpad((98 - _mod97(F.concat(country, F.lit("00"), rest))).cast("string"), 2, "0")
    return F.when(_mod97(value) == 1, F.concat(country, check, rest)).otherwise(drawn)


def _in_notation(value: Column, form: Column) -> Column:
    """The characters of ``form`` in the places of the value's digits and letters."""

    def one(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), PARTED, ""))
        return F.when(c.rlike(PARTED), c).otherwise(F.substring(form, before, F.lit(1)))

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _grown(words: Sequence[str], name: Column, attempt: Column) -> Column:
    """A word of the list; every attempt after the second joins one more on, so there is room for any number."""
    stream = F.sha2(F.concat(name, F.lit(":more")), 512)
    more = F.transform(F.sequence(F.lit(1), F.greatest(attempt - 1, F.lit(1))), lambda i: F.lower(_pick(words, _number(stream, i))))
    first = _pick(words, _number(stream, F.lit(0)))
    return F.when(attempt > 1, F.concat(first, F.array_join(more, ""))).otherwise(first)


def _by_script(word: Column, lists: dict[str, Sequence[str]], name: Column, attempt: Column) -> Column:
    """A name from the list of the word's script, the Latin one where there is none."""
    out = lambda script: _grown(lists[script], name, attempt)
    return F.when(word.rlike(r"^\p{IsCyrillic}"), out("Cyrillic")).when(word.rlike(r"^\p{IsGreek}"), out("Greek")).otherwise(out(""))


def draw(kind: Column, value: Column, key: str, attempt: Column) -> Column:
    """Surrogate of a part in its kind's format, from a keyed hash of kind, value and attempt."""
    name = F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string"))
    stream = _digits(name, F.length(value))
    at = F.instr(value, "@")
    local = _redrawn(F.substring(value, F.lit(1), at - 1), stream, True)
    # the name of the host is redrawn, its first label's and last label's form stay
    host = F.regexp_extract(value, "@(.*)\\.[A-Za-z]{2,}$", 1)
    ending = F.regexp_extract(value, "(\\.[A-Za-z]{2,})$", 1)
    email = F.concat(local, F.lit("@"), _redrawn(host, _digits(F.concat_ws("|", F.lit(key), F.lit("host"), F.regexp_extract(value, "@(.*)$", 1), attempt.cast("string")), F.length(host)), True), ending)
    kept = F.regexp_extract(value, PRIVATE, 1)
    octets = F.transform(F.split(F.substring(value, F.length(kept) + 1, F.length(value)), "\\."), lambda c, i: (1 + _number(stream, i) % 254).cast("string"))
    ip = F.concat(kept, F.array_join(octets, "."))
    given_name = F.substring(value, F.lit(3), F.length(value))
    of = lambda gender: {script: NAMES[f"{script} {gender}".strip()] for script in SURNAMES}
    given = F.when(value.startswith("f:"), _by_script(given_name, of("f"), name, attempt)).otherwise(_by_script(given_name, of("m"), name, attempt))
    country = F.regexp_extract(value, COUNTRY, 1)
    phone = F.concat(country, _redrawn(F.substring(value, F.length(country) + 1, F.length(value)), stream, False))
    iban = F.concat(F.substring(value, 1, 2), _redrawn(F.substring(value, F.lit(3), F.length(value)), stream, True))
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "given", given).when(kind == "surname", _by_script(value, SURNAMES, name, attempt))
        .when(kind == "phone", phone).when(kind == "iban", _iban(value, iban)).when(kind == "secret", _redrawn(value, stream, True, True))
        .when(kind == "card", _card(value, _redrawn(value, stream, False))).otherwise(_redrawn(value, stream, False))
    )


def drawn_parts(parts: DataFrame, key: str) -> DataFrame:
    """(part, form, surrogate): one surrogate per distinct ``form`` of a part, none of them a form that occurs, no two alike.

    All forms draw at once. Of the forms that drew alike the smallest keeps its
    draw; the others, and those that drew a form of the corpus, draw again.
    """
    wanted = written(parts.distinct(), "parts")
    bare = F.when(F.col("part") == "given", F.substring("form", F.lit(3), F.length("form"))).otherwise(F.col("form"))
    taken = wanted.select("part", bare.alias("surrogate")).distinct()
    drawn = None
    open_ = wanted
    for attempt in range(ROUNDS):
        fresh = open_.select("part", "form", draw(F.col("part"), F.col("form"), key, F.lit(attempt)).alias("surrogate"))
        free = fresh.join(taken, ["part", "surrogate"], "left_anti")
        if drawn is not None:
            free = free.join(drawn.select("part", "surrogate"), ["part", "surrogate"], "left_anti")
        won = cut_lineage(free.groupBy("part", "surrogate").agg(F.min("form").alias("form")).select("part", "form", "surrogate"))
        drawn = won if drawn is None else drawn.union(won)
        open_ = cut_lineage(open_.join(won, ["part", "form"], "left_anti"))
        if open_.isEmpty():
            return drawn
    raise ValueError(f"no distinct surrogates after {ROUNDS} draws: a kind's format has too few forms")  # never names


def surrogate_table(values: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate): the surrogate of each ``value`` of a kind, in the value's own notation.

    Parts are drawn each by itself: notations of one number get one surrogate, and
    a surname or given name the same one in all names that hold it.
    """
    rows = values.distinct().select("kind", "value", F.posexplode(parts_of(F.col("kind"), F.col("value"))).alias("at", "p")).select("kind", "value", "at", "p.part", "p.form")
    rows = written(rows, "values")
    found = rows.join(drawn_parts(rows.select("part", "form"), key), ["part", "form"])
    whole = found.groupBy("kind", "value").agg(F.array_sort(F.collect_list(F.struct("at", "surrogate")))["surrogate"].alias("drawn"))
    kind, value, first = F.col("kind"), F.col("value"), F.col("drawn")[0]
    title = F.regexp_extract(value, f"^{TITLED} ", 0)
    marks = F.regexp_extract_all(F.regexp_replace(value, f"^{TITLED} ", ""), F.lit("[ -]"), F.lit(0))
    person = F.concat(title, F.array_join(F.transform("drawn", lambda d, i: F.concat(d, F.coalesce(F.get(marks, i), F.lit("")))), ""))
    shouted = (value == F.upper(value)) & (value != F.lower(value))
    text = F.when(kind == "name", person).when(kind.isin("card", "iban", "phone"), _in_notation(value, first))
    text = text.when(kind.isin("email", "secret") & shouted, F.upper(first)).otherwise(first)
    return whole.select("kind", "value", text.alias("surrogate"))


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its entities replaced: doc_id, n_entities, kinds, text.

    Equal values, whatever their case, blanks and signs, get one surrogate in all
    documents, and so does each given name and surname, whatever the title, so
    coreference is kept; different values get different ones. Formats stay:
    separators, lengths, letter case, country codes, check digits that were right,
    private octets, titles, hyphens, script and gender of a name. Who has not the
    ``key`` cannot tell what a surrogate stands for.
    A text is cut at its entities and put together again, so a surrogate is
    never taken for a value. Texts without entities come out as they are; null
    texts stay null with 0 entities. Rows that share a doc_id are rewritten each
    by itself; those without one too.
    """
    rows = docs.select("doc_id", "text", _matches(F.coalesce("text", F.lit(""))).alias("found"))
    plain = rows.where(F.size("found") == 0).select("doc_id", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("kinds"), "text")
    held = written(rows.where(F.size("found") > 0).select("doc_id", "text", "found", F.xxhash64("doc_id", "text").alias("row")), "held")
    spots = held.select("row", F.explode(F.array_distinct("found")).alias("written")).distinct()
    spots = spots.select("row", "written", kind_of(F.col("written")).alias("kind"))
    table = surrogate_table(spots.select("kind", F.col("written").alias("value")), key).withColumnRenamed("value", "written")
    known = spots.join(table, ["kind", "written"])
    per_row = known.groupBy("row").agg(F.map_from_entries(F.collect_set(F.struct("written", "surrogate"))).alias("to"), F.concat_ws(",", F.array_sort(F.collect_set("kind"))).alias("kinds"))
    pieces, after = F.split("text", ENTITY, -1), F.transform("found", lambda v: F.element_at("to", v))
    text = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(after, i), F.lit("")))), "")
    done = held.join(per_row, "row").select("doc_id", F.size("found").cast("long").alias("n_entities"), "kinds", text.alias("text"))
    return plain.union(done)
