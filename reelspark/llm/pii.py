"""PII: detected entities get keyed surrogates of the same kind and format.

All in DataFrame functions. One pattern finds all entities. A surrogate is a function
of a secret key, the entity's type and its canonical form, so that one entity has one
surrogate wherever and however it is written, and its format (case, separators,
prefixes, lengths; script and gender of names) stays. The distinct entities of the
corpus are checked: where two would share a surrogate, or a surrogate would be another
entity, one of them is drawn anew until all are distinct.

Of a name, the given name and the surname are entities of their own, each with its
surrogate, so that all forms of one name agree. A name is found behind an honorific or
before a birth date; from there on, the text's own names are found wherever they stand.
Birth dates move by amounts that the key tells, one to one, so that no two become one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import checkpoint, settled

#: Attempts that go into the query as literals at most; more are joined by document.
LITERAL_ATTEMPTS = 200
#: Draws that keep the length; each further one adds a digit or letter, so that there is no end of surrogates.
SAME_LENGTH = 8

# Honorifics by script and gender, and given names for surrogates.
MALE = "Mr|Mister|Herr|Monsieur|Señor|Sr|Don"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Doña"
MALE_CYRILLIC = "господин|Господин|г-н"
FEMALE_CYRILLIC = "госпожа|Госпожа|г-жа"
GIVEN = {
    ("latin", "male"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Nils", "Oscar", "Paul"),
    ("latin", "female"): ("Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Irene", "Julia", "Klara", "Laura", "Maria", "Nora", "Olga", "Paula"),
    ("cyrillic", "male"): ("Андрей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Сергей", "Тимур"),
    ("cyrillic", "female"): ("Анна", "Белла", "Вера", "Галина", "Дарья", "Ева", "Зоя", "Инна", "Кира", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Римма", "Софья"),
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga go ha he ja jo ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe pi po ra re ri ro sa se si so ta te ti to va ve vi vo wa we za ze zi zo bra dre fri gro kla ple sto tri".split(),
    "cyrillic": "ба бе би бо да де ди до фа фе га го ха хе жа жо ка ке ки ко ла ле ли ло ма ме ми мо на не ни но па пе пи по ра ре ри ро са се си со та те ти то ва ве ви во ша ше за зе зи зо бра дре фри гро кла пле сто три".split(),
}

#: The country's one, two or three digits behind a plus sign.
COUNTRY = r"^\+([17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
SECRET_NAMES = "password|passwd|pwd|passphrase|secret|token|api_key|apikey|api-key"
# What stands before a birth date, and kinds of streets and the particles of their names.
BORN = "born|Born|DOB|date of birth|Date of birth|geboren|geb\\.|née?|nacid[oa]"
STREETS = "Street|St|Road|Rd|Avenue|Ave|Lane|Drive|Boulevard|Blvd|Court|Square|Terrace"
STREET_ENDS = "straße|strasse|weg|platz|gasse|allee"
STREET_WORDS = "rue|avenue|boulevard|place|Calle|Avenida|Plaza"
PARTICLES = "de|du|des|del|la|le|el|los|las"
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December|Januar|Februar|März|Mai|Juni|Juli|Oktober|Dezember"
_DATE = rf"(?:\d{{4}}-\d{{2}}-\d{{2}}|\d{{1,2}}[./-]\d{{1,2}}[./-](?:\d{{4}}|\d{{2}})|\d{{1,2}}\.? (?:{MONTHS}) \d{{4}}|(?:{MONTHS}) \d{{1,2}}, \d{{4}}|\d{{4}})(?!\w)"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
_TITLE = rf"(?:{MALE}|{FEMALE}|{MALE_CYRILLIC}|{FEMALE_CYRILLIC})\.?[ ]"
#: Type and pattern, the first that matches at a place counts.
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9](?:[\w.+-]*[\w+-])?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![A-Za-z])",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "phone": r"(?<![\w.])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\w)|(?<![\w.-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-])",
    "card": r"(?<![\w.-])(?:3[47]\d{2}[ -]?\d{6}[ -]?\d{5}|[2-6]\d{3}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "access_key": r"(?<!\w)A[KS]IA[A-Z0-9]{16}(?!\w)",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])",
    "credential": rf"(?<=(?i:{SECRET_NAMES})[ ]{{0,2}}[=:][ ]{{0,2}}[\"']{{0,1}})[A-Za-z0-9_+/.-]{{6,}}",
    "name": rf"(?<!\w){_TITLE}{_NAME}(?:[ ]{_NAME})?|(?<![\p{{L}}\w]){_NAME}[ ]{_NAME}(?=,? (?:{BORN})[ :,])",
    "birth": rf"(?<=\b(?:{BORN})[ :]{{1,2}}(?:on |in |am |le |el )?){_DATE}",
    "address": rf"(?<![\w.,])\d{{1,5}}[A-Za-z]?[ ](?:{_NAME}[ ]){{1,3}}(?:{STREETS})(?!\p{{L}})|(?<!\p{{L}})\p{{Lu}}[\p{{L}}-]*(?:{STREET_ENDS})[ ]\d{{1,4}}[a-z]?(?!\w)|(?<![\w.,])\d{{1,4}},? (?:rue|avenue|boulevard|place) (?:(?:{PARTICLES}) ){{0,2}}(?:[ld]['’])?{_NAME}|(?<!\p{{L}})(?:Calle|Avenida|Plaza) (?:(?:{PARTICLES}) ){{0,2}}{_NAME},? \d{{1,4}}(?!\w)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Texts without any of these have no entity; one cheap look spares them the long pattern.
MAYBE = rf"[0-9@=:]|(?=[MHSDFгГ])(?:{MALE}|{FEMALE}|{MALE_CYRILLIC}|{FEMALE_CYRILLIC})\.? \p{{Lu}}|A[KS]IA[A-Z0-9]{{16}}|[a-f]{{32}}|[A-F]{{32}}"


#: Kinds whose patterns look at what stands beside them, by their own shape, in the order in which they count; else it's a credential.
_SHAPES = PATTERNS | {"name": rf"{_TITLE}{_NAME}(?:[ ]{_NAME})?|{_NAME}[ ]{_NAME}", "birth": _DATE}
#: Texts in which a name may be introduced.
INTRODUCES = rf"{_TITLE}\p{{Lu}}|(?:{BORN})[ :,]"


def _kind(found: Column) -> Column:
    out = F.lit(None)
    for kind, pattern in reversed(_SHAPES.items()):
        out = F.when(found.rlike(rf"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return F.coalesce(out, F.lit("credential"))  # its pattern looks at what stands before


def _bare(name: Column) -> Column:
    """A name without its honorific."""
    return F.regexp_replace(name, rf"^{_TITLE}", "")


def _female(name: Column) -> Column:
    """Whether a name is a woman's: by its honorific, else by its given name."""
    given = F.split_part(name, F.lit(" "), F.lit(1))
    known = given.isin(*GIVEN["latin", "female"], *GIVEN["cyrillic", "female"]) | given.rlike("[aа]$") & ~given.isin(*GIVEN["latin", "male"], *GIVEN["cyrillic", "male"])
    return F.when(name.rlike(rf"^{_TITLE}"), name.rlike(rf"^(?:{FEMALE}|{FEMALE_CYRILLIC})\.? ")).otherwise(known)


def _canon(kind: Column, found: Column) -> Column:
    """The same for all ways to write an entity; of a given name, the gender stands before it."""
    digits = F.regexp_replace(found, r"\D", "")
    return (
        F.when(kind == "phone", F.concat(F.regexp_extract(found, r"^(\+?)", 1), digits))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "iban", F.regexp_replace(found, " ", ""))
        .when(kind.isin("email", "secret", "surname", "address"), F.lower(found))
        .otherwise(found)
    )


def _parts(name: Column, female: Column) -> tuple[Column, Column, Column, Column]:
    """(given name, its canonical form, surname, its canonical form) of a name without honorific; without a given name, the first two are empty."""
    given, surname = F.regexp_extract(name, r"^(\S+) \S", 1), F.regexp_extract(name, r"(\S+)$", 1)
    return given, F.when(given != "", F.concat(F.when(female, "female ").otherwise("male "), F.lower(given))).otherwise(F.lit("")), surname, F.lower(surname)


def _draw(key: str, kind: Column, canon: Column, attempt: Column, use: str) -> Column:
    """64 keyed hexadecimal digits."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(use), kind, canon, attempt.cast("string")), 256)


def _digit_at(drawn: Column, i: Column) -> Column:
    """A decimal digit out of three hexadecimal ones (so nearly even), cycling through drawn."""
    return (F.conv(F.substring(drawn, i * 3 % 60 + 1, F.lit(3)), 16, 10).cast("int") % 10).cast("string")


def _filled(form: Column, drawn: Column, keep: Column) -> Column:
    """form with all but the first keep digits drawn anew; what isn't a digit stays."""
    at = F.struct(F.lit("").alias("s"), F.lit(0).alias("i"))

    def step(done: Column, c: Column) -> Column:
        new = F.when(done["i"] < keep, c).otherwise(_digit_at(drawn, done["i"]))
        digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(done["s"], F.when(digit, new).otherwise(c)).alias("s"), (done["i"] + digit.cast("int")).alias("i"))

    return F.aggregate(F.split(form, ""), at, step, lambda done: done["s"])


def _checked(form: Column) -> Column:
    """form with its last digit such that the digits pass the Luhn test."""
    digits = F.reverse(F.regexp_replace(form, r"\D", ""))
    places = F.sequence(F.lit(2), F.length(digits))

    def worth(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x)
    return F.concat(F.regexp_replace(form, r"\d$", ""), F.pmod(-total, F.lit(10)).cast("string"))


def _bound(value: Column, body) -> Column:
    """body(value), with value worked out once, and not for each character that looks it up."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _lettered(form: Column, drawn: Column) -> Column:
    """form with letters for letters and digits for digits, case kept; in a time that grows with its length."""

    def new(c: Column, i: Column) -> Column:
        n = F.conv(F.substring(drawn, i * 3 % 60 + 1, F.lit(3)), 16, 10).cast("int")
        letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), n % 26 + 1, F.lit(1))
        return F.when(c.rlike("^[0-9]$"), (n % 10).cast("string")).when(c.rlike(r"^\p{Lu}$"), F.upper(letter)).when(c.rlike(r"^\p{L}$"), letter).otherwise(c)

    return F.array_join(F.transform(F.split(form, ""), new), "")


def _hex_for(form: Column, drawn: Column) -> Column:
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.length(form) / 64).cast("int")), lambda i: F.sha2(F.concat(drawn, i.cast("string")), 256))
    long = F.substring(F.array_join(blocks, ""), F.lit(1), F.length(form))
    return F.when(form.rlike("[A-F]"), F.upper(long)).otherwise(long)


def _laid(form: Column, image: Column) -> Column:
    """image with form's blanks where they stand there."""
    at = F.struct(F.lit("").alias("s"), F.lit(0).alias("i"))

    def step(done: Column, c: Column) -> Column:
        blank = c == " "
        return F.struct(F.concat(done["s"], F.when(blank, c).otherwise(F.substring(image, done["i"] + 1, F.lit(1)))).alias("s"), (done["i"] + (~blank).cast("int")).alias("i"))

    return F.aggregate(F.split(form, ""), at, step, lambda done: done["s"])


def _account(canon: Column, drawn: Column) -> Column:
    """An account number of the same country and letter pattern, whose two check digits hold (modulo 97)."""
    body = _lettered(F.substring(canon, F.lit(5), F.length(canon)), drawn)
    country = F.substring(canon, 1, 2)

    def step(rest: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        worth = F.when(digit, c.cast("int")).otherwise(F.ascii(c) - 55)  # A is 10
        return F.when(c == "", rest).otherwise((rest * F.when(digit, 10).otherwise(100) + F.coalesce(worth, F.lit(0))) % 97)

    return _bound(body, lambda x: F.concat(country, F.lpad((98 - F.aggregate(F.split(F.concat(x, country, F.lit("00")), ""), F.lit(0), step)).cast("string"), 2, "0"), x))


def _pick(values, drawn: Column, place: int) -> Column:
    return F.get(F.array(*map(F.lit, values)), F.conv(F.substring(drawn, place, 3), 16, 10).cast("int") % len(values))


def _syllables(drawn: Column, n: Column, script: str) -> Column:
    """A capitalised name of n syllables."""
    syllables = F.array(*map(F.lit, SYLLABLES[script]))
    parts = F.transform(F.sequence(F.lit(1), n), lambda i: F.get(syllables, F.conv(F.substring(F.sha2(F.concat(drawn, i.cast("string")), 256), 1, 3), 16, 10).cast("int") % len(SYLLABLES[script])))
    return F.initcap(F.array_join(parts, ""))


def _as_written(made: Column, form: Column) -> Column:
    return F.when((F.length(form) > 1) & (form == F.upper(form)), F.upper(made)).otherwise(made)


def _surname(canon: Column, form: Column, drawn: Column, attempt: Column) -> Column:
    """A surname in the script of canon; each further draw has a syllable more, so that there is no end of them."""
    n = 3 + attempt
    return _as_written(F.when(canon.rlike(r"\p{IsCyrillic}"), _syllables(drawn, n, "cyrillic")).otherwise(_syllables(drawn, n, "latin")), form)


def _given(canon: Column, form: Column, drawn: Column, attempt: Column) -> Column:
    """A given name of the same gender and script; each further draw has one more behind a hyphen."""

    def of(script: str, gender: str) -> Column:
        names = F.array(*map(F.lit, GIVEN[script, gender]))
        return F.array_join(F.transform(F.sequence(F.lit(0), attempt), lambda i: F.get(names, F.conv(F.substring(F.sha2(F.concat(drawn, i.cast("string")), 256), 1, 3), 16, 10).cast("int") % len(GIVEN[script, gender]))), "-")

    by_gender = lambda script: F.when(canon.startswith("female "), of(script, "female")).otherwise(of(script, "male"))
    return _as_written(F.when(canon.rlike(r"\p{IsCyrillic}"), by_gender("cyrillic")).otherwise(by_gender("latin")), form)


def _moved(key: str, form: Column) -> Column:
    """A birth date with its years, months and days moved in circles of their own (100 years, 12, and 13 to 28), by steps that the key tells; one to one, and a date again."""
    step = lambda use, n: F.conv(F.substring(F.sha2(F.lit(f"{key}\x1f{use}"), 256), 1, 6), 16, 10).cast("int") % (n - 1) + 1

    def token(x: Column) -> Column:
        n = x.try_cast("int")
        year = F.floor(n / 100) * 100 + (n + step("year", 100)) % 100
        low, high = (n - 1 + step("month", 12)) % 12 + 1, (n - 13 + step("day", 16)) % 16 + 13
        made = F.when(F.length(x) == 4, year).when(n.between(1, 12), low).when(n.between(13, 28), high).otherwise(n)
        return F.when(x.rlike(r"^\d+$"), F.lpad(made.cast("string"), F.greatest(F.length(x), F.length(made.cast("string"))), "0")).otherwise(x)

    return F.array_join(F.transform(F.regexp_extract_all(form, F.lit(r"\d+|\D+"), F.lit(0)), token), "")


def _elsewhere(canon: Column, form: Column, drawn: Column, attempt: Column) -> Column:
    """An address of the same layout: other numbers, other names, the kind of street as it is."""
    keep = rf"^(?:{STREETS}|{STREET_WORDS}|{PARTICLES}|[ldLD]['’])$"

    def token(x: Column, i: Column) -> Column:
        return _bound(F.sha2(F.concat(drawn, i.cast("string")), 256), lambda own: of(x, own))

    def of(x: Column, own: Column) -> Column:
        name = _syllables(own, 2 + attempt, "latin")
        digits = F.concat((F.conv(F.substring(own, 1, 3), 16, 10).cast("int") % 9 + 1).cast("string"), F.array_join(F.transform(F.sequence(F.lit(2), F.lit(5)), lambda k: (F.conv(F.substring(own, k * 3, F.lit(3)), 16, 10).cast("int") % 10).cast("string")), ""))
        end = F.regexp_extract(x, rf"({STREET_ENDS})$", 1)
        return F.when(x.rlike(r"^\d+$"), F.substring(digits, F.lit(1), F.length(x))).when(x.rlike(keep) | ~x.rlike(r"^\p{Lu}"), x).when(x.rlike(r"^\p{Lu}$"), x).when(end != "", F.concat(name, end)).otherwise(name)

    return F.array_join(F.transform(F.regexp_extract_all(form, F.lit(r"[ldLD]['’]|\p{L}[\p{L}'’-]*|\d+|[^\p{L}\d]+"), F.lit(0)), token), "")


def surrogate(key: str, kind: Column, canon: Column, attempt: Column, form: Column) -> Column:
    """What stands in place of an entity written as form."""
    return _bound(_draw(key, kind, canon, attempt, "entity"), lambda drawn: _drawn_as(key, kind, canon, attempt, form, drawn))


def _drawn_as(key: str, kind: Column, canon: Column, attempt: Column, form: Column, drawn: Column) -> Column:
    domain = _draw(key, F.lit("domain"), F.regexp_extract(canon, "@(.*)$", 1), F.lit(0), "domain")
    wider = F.greatest(attempt - (SAME_LENGTH - 1), F.lit(0))
    more = lambda x, c: F.concat(x, F.repeat(F.lit(c), wider))
    # wider octets are those of no address
    octet = lambda i: (F.conv(F.substring(drawn, 8 * i + 1, 6), 16, 10).cast("int") % (223 if i == 0 else 254) + 1 + 256 * wider).cast("string")
    # the country's digits stay, told by the number itself, however it is written
    prefix = F.length(F.regexp_extract(canon, COUNTRY, 1))
    return (
        F.when(kind == "email", F.concat(_lettered(more(F.regexp_extract(form, "^(.*)@", 1), "a"), drawn), F.lit("@"), _bound(domain, lambda x: _lettered(F.lit("mailhost"), x)), F.when(form.rlike("[a-z]"), F.lit(".example.org")).otherwise(F.lit(".EXAMPLE.ORG"))))
        .when(kind == "ip", F.concat_ws(".", *[octet(i) for i in range(4)]))
        .when(kind == "iban", _bound(_account(more(canon, "0"), drawn), lambda image: _laid(more(form, "0"), image)))
        .when(kind == "phone", _filled(more(form, "0"), drawn, prefix))
        .when(kind == "card", _checked(_filled(more(form, "0"), drawn, F.lit(1))))
        .when(kind == "ssn", _filled(F.concat(F.lit("9"), more(F.substring(form, 2, 10), "0")), drawn, F.lit(1)))
        .when(kind == "access_key", F.concat(F.substring(form, 1, 4), _lettered(more(F.substring(form, 5, 16), "A"), drawn)))
        .when(kind == "credential", _lettered(more(form, "a"), drawn))
        .when(kind == "surname", _surname(canon, form, drawn, attempt))
        .when(kind == "given", _given(canon, form, drawn, attempt))
        .when(kind == "birth", _moved(key, form))
        .when(kind == "address", _elsewhere(canon, form, drawn, attempt))
        .otherwise(_hex_for(more(form, "0"), drawn))
    )


_NOTHING = "cast(array() as array<string>)"


def _entities(df: DataFrame, keep: list[str]) -> DataFrame:
    """df's columns in keep, _pieces of _t between the entities, and _found: their forms, kinds, canonical forms and parts of names."""
    maybe = F.col("_t").rlike(MAYBE)
    names = F.when(F.col("_t").rlike(INTRODUCES), F.array_distinct(F.regexp_extract_all("_t", F.lit(PATTERNS["name"]), F.lit(0)))).otherwise(F.expr(_NOTHING))
    df = settled(df, [*keep, "_t"], _names=F.when(maybe, names).otherwise(F.expr(_NOTHING)))
    # of each name that the text introduces, how it may stand alone: whole, and its surname
    told = F.transform("_names", lambda x: F.struct(_bare(x).alias("name"), _female(x).alias("female")))
    df = settled(df, [*keep, "_t"], _told=told)
    alone = F.array_distinct(F.concat(F.transform("_told", lambda x: x["name"]), F.transform("_told", lambda x: F.regexp_extract(x["name"], r"(\S+)$", 1))))
    df = settled(df, [*keep, "_t", "_told"], _alone=alone)
    own = F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}_])(?:"), F.array_join("_alone", "|"), F.lit(r")(?![\p{L}\p{N}_])"))
    named = F.size("_alone") > 0
    df = settled(
        df, [*keep, "_told", "_alone"],
        _pieces=F.when(~maybe, F.array("_t")).when(named, F.split("_t", own, -1)).otherwise(F.split("_t", ANY, -1)),
        _forms=F.when(~maybe, F.expr(_NOTHING)).when(named, F.regexp_extract_all("_t", own, F.lit(0))).otherwise(F.regexp_extract_all("_t", F.lit(ANY), F.lit(0))),
    )
    kind = lambda x: F.when(F.array_contains("_alone", x), F.lit("name")).otherwise(_kind(x))
    # what stands alone has the gender of the name that introduced it
    by_told = lambda x: F.get(F.filter("_told", lambda t: t["name"] == x), F.lit(0))["female"]
    df = settled(df, [*keep, "_pieces"], _kinds=F.transform("_forms", lambda x: F.struct(x.alias("form"), kind(x).alias("kind"), F.coalesce(by_told(x), _female(x)).alias("female"))))

    def whole(x: Column) -> Column:
        given, given_canon, surname, surname_canon = _parts(_bare(x["form"]), x["female"])
        is_name = x["kind"] == "name"
        only = lambda c: F.when(is_name, c).otherwise(F.lit(""))
        return F.struct(x["form"].alias("form"), x["kind"].alias("kind"), F.when(is_name, surname_canon).otherwise(_canon(x["kind"], x["form"])).alias("canon"), only(surname).alias("surname"), only(given).alias("given"), only(given_canon).alias("given_canon"))

    return settled(df, [*keep, "_pieces"], _found=F.transform("_kinds", whole))


def _drawn_ones(found: str) -> Column:
    """The entities of _found that get a draw: of a name, its parts."""
    of = lambda kind, canon, form: F.struct(kind.alias("kind"), canon.alias("canon"), form.alias("form"))
    return F.flatten(F.transform(found, lambda x: F.when(x["kind"] != "name", F.array(of(x["kind"], x["canon"], x["form"])))
        .when(x["given"] == "", F.array(of(F.lit("surname"), x["canon"], x["surname"]))).otherwise(F.array(of(F.lit("surname"), x["canon"], x["surname"]), of(F.lit("given"), x["given_canon"], x["given"])))))


def attempts(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt) of the entities (kind, canon, form) that need another draw than the first.

    All distinct entities are drawn; those that share a surrogate with one before them,
    or whose surrogate is an entity of the corpus, are drawn again, until none is left;
    as longer and longer ones are drawn, that comes to an end however many there are.
    Only distinct entities are shuffled, by their own values.
    """
    # a fixed number of partitions, as the engine would merge those of few bytes, and drawing is what costs
    spread = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # birth dates move one to one
    distinct = checkpoint(entities.filter("kind <> 'birth'").groupBy("kind", "canon").agg(F.min("form").alias("form")).repartition(spread, "kind", "canon"))
    taken = distinct.select("kind", F.col("canon").alias("image"), F.lit(True).alias("is_entity"))
    drawn = distinct.withColumn("attempt", F.lit(0))
    while True:
        made = surrogate(key, F.col("kind"), F.col("canon"), F.col("attempt"), F.col("form"))
        gender = F.split_part("canon", F.lit(" "), F.lit(1))
        image = lambda x: F.when(F.col("kind") == "given", F.concat(gender, F.lit(" "), F.lower(x))).otherwise(_canon(F.col("kind"), x))
        seen = drawn.withColumn("image", _bound(made, image))
        first = seen.groupBy("kind", "image").agg(F.min_by("canon", F.struct("attempt", "canon")).alias("first"), F.count("*").alias("n"))
        clash = first.join(taken, ["kind", "image"], "left").filter((F.col("n") > 1) | F.col("is_entity"))
        losers = seen.join(clash, ["kind", "image"]).filter(F.col("is_entity").isNotNull() | (F.col("canon") != F.col("first"))).select("kind", "canon", F.lit(1).alias("again"))
        losers = checkpoint(losers)
        if not losers.head(1):
            return drawn.filter("attempt > 0").select("kind", "canon", "attempt")
        again = drawn.join(losers, ["kind", "canon"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0))).drop("again")
        drawn = checkpoint(again.repartition(spread, "kind", "canon"))


def replace_entities(df: DataFrame, key: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with text_col's entities replaced, and n_entities and entity_kinds added (or put in place of such columns).

    Every row and other column stays; a null text stays null with no entities, an empty
    one empty; ids may be null and rows may repeat; an empty df gives no rows. The text
    outside of entities stays as it is. Texts are taken apart once and written so.
    Without clashes, documents take part in no shuffle; up to LITERAL_ATTEMPTS redrawn
    entities are literals of the query, more come back to their rows by a join on the
    row's number.
    """
    names = [c for c in df.columns if c not in ("n_entities", "entity_kinds")]
    columns = [f"_c{i}" for i in range(len(names))]  # whatever the columns are called
    text_is = columns[names.index(text_col)]
    own = df.select(*[df[f"`{c}`"].alias(x) for c, x in zip(names, columns)], F.coalesce(df[text_col].cast("string"), F.lit("")).alias("_t"))
    # the long patterns run once; rows get a number, as ids may be null and repeat
    cut = checkpoint(_entities(own, columns).withColumn("_row", F.monotonically_increasing_id()))
    again = checkpoint(attempts(cut.select(F.explode(_drawn_ones("_found")).alias("x")).select("x.kind", "x.canon", "x.form"), key))
    few = again.limit(LITERAL_ATTEMPTS + 1).collect()
    name = lambda kind, canon: F.concat(kind, F.lit(" "), canon)
    if len(few) > LITERAL_ATTEMPTS:
        where = cut.select("_row", F.explode(_drawn_ones("_found")).alias("x"))
        drawn = where.select("_row", "x.kind", "x.canon").distinct().join(again, ["kind", "canon"])
        by_row = drawn.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct(F.concat("kind", F.lit(" "), "canon"), "attempt"))).alias("_again"))
        cut = cut.join(by_row, "_row", "left")
        attempt = lambda kind, canon: F.coalesce(F.col("_again")[name(kind, canon)], F.lit(0))
    elif few:
        literal = F.create_map(*[F.lit(v) for r in few for v in (f"{r.kind} {r.canon}", r.attempt)])
        attempt = lambda kind, canon: F.coalesce(literal[name(kind, canon)], F.lit(0))
    else:
        attempt = lambda kind, canon: F.lit(0)

    def made_of(x: Column) -> Column:
        def part(kind: str, canon: Column, form: Column, n: Column, make) -> Column:
            return _bound(_draw(key, F.lit(kind), canon, n, "entity"), lambda drawn: make(canon, form, drawn, n))

        title = F.regexp_extract(x["form"], rf"^({_TITLE})", 1)
        given = F.when(x["given"] == "", F.lit("")).otherwise(F.concat(part("given", x["given_canon"], x["given"], x["given_draws"], _given), F.lit(" ")))
        other = surrogate(key, x["kind"], x["canon"], x["draws"], x["form"])
        return F.when(x["kind"] == "name", F.concat(title, given, part("surname", x["canon"], x["surname"], x["draws"], _surname))).otherwise(other)

    keep = [c for c in cut.columns if c not in ("_again", "_row", "_found")]
    # draws are looked up once, and not wherever an entity's expressions have them
    kind = lambda x: F.when(x["kind"] == "name", F.lit("surname")).otherwise(x["kind"])
    counted = settled(cut, keep, _found=F.transform("_found", lambda x: F.struct(*[x[c].alias(c) for c in ("form", "kind", "canon", "surname", "given", "given_canon")], attempt(kind(x), x["canon"]).alias("draws"), attempt(F.lit("given"), x["given_canon"]).alias("given_draws"))))
    made = settled(counted, [*keep, "_found"], _made=F.transform("_found", made_of))
    joined = F.array_join(F.flatten(F.transform("_pieces", lambda piece, i: F.array(piece, F.coalesce(F.get("_made", i), F.lit(""))))), "")
    text = F.when(F.col(text_is).isNull() | (F.size("_found") == 0), F.col(text_is)).otherwise(joined)
    return made.select(
        *[(text if x == text_is else F.col(x)).alias(c) for c, x in zip(names, columns)],
        F.size("_found").cast("long").alias("n_entities"), F.array_sort(F.array_distinct(F.transform("_found", lambda x: x["kind"]))).alias("entity_kinds"),
    )
