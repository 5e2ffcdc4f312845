"""Surrogates for personal data, in SQL functions only.

Detected entities get keyed replacements of their own kind: digits become digits, letters become
letters of the same case and script, mail stays mail, an address of four octets stays one, a card
number keeps its checksum's remainder, and a name after a title becomes a name of that title's gender.
Given names and the family's have surrogates of their own, so that shorter mentions get the matching
part; a document's words that are part of one of its titled names are replaced without a title too.

A surrogate depends on the key and the entity's canonical form (digits of a number, lower case of an
address or secret), so that every mention of an entity gets the same surrogate in its own format. All
distinct entities of the corpus are checked: surrogates that two entities share, and surrogates that
are themselves an entity of the corpus, are drawn again with the next nonce until none is left. Words
and secrets grow with the nonce, so that their formats cannot be used up. Formats of few values (short
numbers, addresses of a private range) are permuted by the key instead: there no two entities share a
surrogate and none is its own, but one may be another entity of the corpus, as all values may be taken.
Entities are made distinct before they are joined with anything, so that a common one costs one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm.common import documents, text_hash
from loamwork.runtime import cut

KEY = "loamwork"
#: Rounds of drawing again before the build gives up, and those from which on words and secrets get longer.
ROUNDS = 40
LONGER = 8
#: Digits of a number that is permuted rather than drawn, at most.
PERMUTED = 9

# Titles by gender, parts of the names that stand in for others, words inside names,
# words before what is no name and months, letters that start the tokens of services, and country
# calling codes of one and two digits.
MALE = ["Mr", "Herr", "Hr", "Señor", "Sr(?=[.])", "Monsieur", "M(?=[.] )"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Fr(?=[.])", "Señora", "Sra", "Señorita", "Srta", "Madame", "Mme", "Mademoiselle", "Mlle"]
NEUTRAL = ["Dr", "Prof", "Doctor", "Professor"]
MALE_NAMES = ["Albert", "Bruno", "Carl", "David", "Emil", "Frank", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo", "Martin", "Nils", "Oscar", "Paul"]
FEMALE_NAMES = ["Anna", "Berta", "Clara", "Dora", "Emma", "Flora", "Greta", "Helen", "Ida", "Julia", "Klara", "Laura", "Marta", "Nora", "Olga", "Paula"]
SYLLABLES = ["bal", "cor", "dan", "fel", "gar", "hol", "jan", "kel", "lan", "mor", "nel", "pal", "ros", "sol", "tor", "wal"]
PARTICLES = ["van", "von", "der", "den", "de", "del", "della", "di", "da", "du", "la", "le", "zu", "zur", "zum", "ten", "ter", "bin", "ibn", "al"]
ARTICLES = ["the", "The", "a", "A", "an", "An"]
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December", "Mai", "März", "Juni", "Juli"]
_SERVICE = r"gh[opusr]_|github_pat_|glpat-|xox[abeprs]-|sk-|AIza|A[KS]IA"
_CALLING = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"

#: Letters of one case, beside ASCII those of Latin-1, Greek and Cyrillic.
_BLOCKS = [(97, 122), (65, 90), (0xE0, 0xF6), (0xC0, 0xD6), (0xF8, 0xFE), (0xD8, 0xDE), (0x3B1, 0x3C9), (0x391, 0x3A1), (0x430, 0x44F), (0x410, 0x42F)]
_KEY_NAME = r"(?i:passwor[dt]|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']? ?[=:] ?[\"']?"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_TITLES = rf"(?:{'|'.join([*MALE, *FEMALE, *NEUTRAL])})"
_NAME = r"\p{Lu}(?:['’]\p{Lu})?\p{Ll}++(?:\p{Lu}\p{Ll}++)?(?:-\p{Lu}\p{Ll}++)*+(?!\p{L})"
_INITIAL = r"\p{Lu}\.(?= \p{Lu})"
_PARTICLE = rf"(?:{'|'.join(PARTICLES)})(?= )"
#: A text in words, with what untitled names may hold, and what stands between words.
_WORD = r"\p{L}++(?:['’-]\p{Lu}\p{L}++)*+|\P{L}++"
_PEM = r"-----BEGIN (?:(?!PRIVATE)[A-Z]{1,20} ){0,4}+PRIVATE KEY-----"
_PEM_END = r"-----END (?:(?!PRIVATE)[A-Z]{1,20} ){0,4}+PRIVATE KEY-----"
#: Line ends, also as they are written in strings, and the lines before a key's own.
_ENDS = r"(?:\\[rn]|\s)"
_KEY_HEAD = rf"(?:{_ENDS}{{0,8}}[A-Za-z-]{{3,40}}: [^\n]{{1,200}}(?=\n)){{0,6}}+"
#: In order of precedence. Only a private key's block matches across a line.
PATTERNS = {
    # either up to its end mark, or as many full lines as follow; a mark alone is none
    "pem": rf"{_PEM}{_KEY_HEAD}(?:(?={_ENDS}{{0,8}}[A-Za-z0-9+/]{{16}})[A-Za-z0-9+/=\s\\]++{_PEM_END}|(?:{_ENDS}{{0,8}}[A-Za-z0-9+/]{{40,}}+){{1,1000}}+(?:{_ENDS}{{0,8}}[A-Za-z0-9+/]{{1,80}}={{1,2}})?+)",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}\p{M}._%+-]++@(?:[\p{L}\p{N}\p{M}-]{1,63}\.){1,8}\p{L}{2,24}",
    # up to its end, which a full stop is not part of
    "key": rf"{_KEY_NAME}(?=[A-Za-z_+/.=~-]*+[0-9])[A-Za-z0-9_+/.=~-]{{8,}}(?<!\.)",
    "cloud": r"(?<![A-Za-z0-9])(?:A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])|gh[opusr]_[A-Za-z0-9]{36,}+|github_pat_[A-Za-z0-9_]{22,}+|glpat-[A-Za-z0-9_-]{20,}+|xox[abeprs]-[A-Za-z0-9-]{10,}+|sk-[A-Za-z0-9_-]{20,}+|AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-]))",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])|(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{4,}+(?:\.[A-Za-z0-9_-]++|\.(?=\.))(?:\.[A-Za-z0-9_-]++){0,3}+",
    # numbers of a version are no address
    "ip": rf"(?<![A-Za-z0-9.])(?<![Vv]ersion )(?<![Rr]elease )(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3})?+|[A-Z0-9]{11,30}+)(?![A-Za-z0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9]{13,19}(?![0-9])|(?<![0-9]|[0-9][ -])(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![ -]?[0-9])",
    # of what looks like a name the first nine parts at most
    "name": rf"(?<!\p{{L}}){_TITLES}\.? (?:{_TITLES}\.? )?+(?:(?:{_NAME}|{_INITIAL}|{_PARTICLE}) ){{0,4}}?(?:{_NAME})(?: (?:{_INITIAL} |{_PARTICLE} ){{0,3}}+{_NAME}){{0,4}}+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_HINT = rf"[0-9@]|A[KS]IA|eyJ|[0-9a-fA-F]{{32}}|{_SERVICE}|{_PEM}|{_TITLES}\.? \p{{L}}"


def entities(text: Column) -> Column:
    """All matches from left to right as (mention, kind, form); what cannot have one is not searched.

    Each step is an array of its own, so that an expression is evaluated once a mention.
    """
    found = F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    kinds = F.transform(found, lambda m: F.struct(m.alias("mention"), kind(m).alias("kind")))
    return F.transform(kinds, lambda x: F.struct(x["mention"].alias("mention"), x["kind"].alias("kind"), canonical(x["mention"], x["kind"]).alias("form")))


def kind(entity: Column) -> Column:
    """What an entity is; "none" for a number that looks like a card or account but lacks its checksum."""
    found = F.lit("name")
    for name, pattern in reversed([x for x in PATTERNS.items() if x[0] != "name"]):
        what = F.lit(name)
        if name == "card":
            what = F.when(_luhn(F.regexp_replace(entity, "[^0-9]", "")) == 0, what).otherwise(F.lit("none"))
        if name == "iban":
            what = F.when(_mod97(F.regexp_replace(entity, " ", "")) == 1, what).otherwise(F.lit("none"))
        found = F.when(entity.rlike(rf"^(?:{pattern})\z"), what).otherwise(found)
    return found


def _title(entity: Column) -> Column:
    return F.regexp_extract(entity, rf"^(?:{_TITLES}\.? ){{1,2}}", 0)


def _parts(entity: Column) -> Column:
    """(form, word) of each part of a titled name: given names, then the family's; initials and small words have no form."""
    female, male = (rf"^(?:{_TITLES}\.? )?(?:{'|'.join(x)})[. ]" for x in (FEMALE, MALE))
    gender = F.when(entity.rlike(female), F.lit("f:")).when(entity.rlike(male), F.lit("m:")).otherwise(F.lit("n:"))
    words = F.split(F.substring(entity, F.length(_title(entity)) + 1, F.length(entity)), " ")
    # the family's name is the same whatever title stands before it
    form = lambda w, i: F.when(~w.endswith(".") & ~w.rlike(r"^\p{Ll}"), F.when(i == F.size(words) - 1, F.concat(F.lit("name:n:"), w)).otherwise(F.concat(F.lit("given:"), gender, w)))
    return F.transform(words, lambda w, i: F.struct(form(w, i).alias("form"), w.alias("word")))


def forms(found: Column) -> Column:
    """The canonical forms that an element of entities() is replaced by: one, those of a name's parts, or none."""
    mention, what, form = found["mention"], found["kind"], found["form"]
    return F.when(what == "name", F.array_compact(F.transform(_parts(mention), lambda x: x["form"]))).when(what == "none", F.array().cast("array<string>")).otherwise(F.array(form))


def canonical(entity: Column, what: Column) -> Column:
    """The kind and what all mentions of an entity have in common; null for names, whose parts have forms of their own."""
    named = F.regexp_replace(entity, f"^{_KEY_NAME}", "")
    # a secret is the same whether a name stands before it or not
    return (
        F.when(what == "phone", F.concat(F.lit("phone:"), F.regexp_extract(entity, r"^\+?", 0), F.regexp_replace(entity, "[^0-9]", "")))
        .when(what.isin("card", "ssn"), F.concat(what, F.lit(":"), F.regexp_replace(entity, "[^0-9]", "")))
        .when(what == "key", F.concat(F.when(named.rlike(rf"(?i)^(?:{_SERVICE})"), F.lit("cloud:")).otherwise(F.lit("secret:")), F.lower(named)))
        .when(what.isin("email", "secret", "pem", "cloud"), F.concat(what, F.lit(":"), F.lower(entity)))
        .when(what.isin("ip", "iban"), F.concat(what, F.lit(":"), F.regexp_replace(entity, " ", "")))
    )


def _mod97(account: Column) -> Column:
    """The remainder of an account number as its checksum has it: country and check digits at the end, letters as 10 to 35."""
    turned = F.concat(F.substring(account, 5, 99), F.substring(account, 1, 4))
    worth = F.transform(F.split(turned, ""), lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(worth, F.lit(0), lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97)


def _substituted(value: Column, stream: Column, hexadecimal: Column) -> Column:
    """Each digit becomes another digit, each letter another letter of its case and block; other characters stay."""

    def other(c: Column, alphabet: str, draw: Column) -> Column:
        n = len(alphabet)
        place = F.pmod(F.instr(F.lit(alphabet), c) + F.pmod(draw, F.lit(n - 1)), F.lit(n))
        return F.substring(F.lit(alphabet), (place + 1).cast("int"), F.lit(1))

    def one(c: Column, i: Column) -> Column:
        code, draw = F.ascii(c), F.xxhash64(stream, i)
        out = F.when(code.between(48, 57), other(c, "0123456789", draw)).when(hexadecimal & code.between(97, 102), other(c, "abcdef", draw))
        for first, last in _BLOCKS:
            out = out.when(code.between(first, last), other(c, "".join(map(chr, range(first, last + 1))), draw))
        # letters outside the blocks become those of their script, or of ASCII
        han = F.decode(F.unhex(F.hex(F.lit(0x4E00) + F.pmod(draw, F.lit(20000)))), "UTF-16BE")
        out = out.when(c.rlike(r"\p{IsHan}"), han).when(c.rlike(r"\p{Lu}"), other(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", draw))
        return out.when(c.rlike(r"\p{L}"), other(c, "abcdefghijklmnopqrstuvwxyz", draw)).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(digits: Column) -> Column:
    """The checksum's remainder of a string of digits."""
    worth = F.transform(F.split(F.reverse(digits), ""), lambda c, i: c.cast("int") * (1 + i % 2))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10


def _head(what: Column, value: Column) -> Column:
    """What a surrogate keeps: the calling code, the mark of a service's token or private key, the account's country, the gender."""
    return (
        F.when(what == "phone", F.regexp_extract(value, rf"^\+(?:{_CALLING})", 0)).when(what.isin("cloud", "pem"), F.regexp_extract(value, rf"(?i)^(?:{_SERVICE}|{_PEM})", 0))
        .when(what == "iban", F.substring(value, 1, 4)).when(what.isin("name", "given"), F.substring(value, 1, 2)).otherwise("")
    )


def _permuted(named: DataFrame, key: str) -> DataFrame:
    """`named` with _permuted, the surrogate value of a number of few digits or an address of a private range, else null.

    A value is cut in halves, each of which is moved four times by a keyed hash of the other; one is
    added, and the halves are moved back. That is one cycle through all values of the format, so that
    each value has another one of its own.
    """
    what, value = F.col("_kind"), F.col("_value")
    range_ = F.when(what == "ip", F.regexp_extract(value, r"^(?:10|127|0|192\.168|169\.254|172\.(?:1[6-9]|2[0-9]|3[01]))\.", 0)).otherwise("")
    rest = F.expr("substring(_value, length(_head) + 1)")
    digits = F.when(what.isin("phone", "ssn") & F.length(rest).between(1, PERMUTED), rest)
    octet = lambda i: F.get(F.split(value, "[.]"), F.lit(i)).cast("long")
    wide = F.length(F.regexp_replace("_range", "[^.]", "")) == 1
    low = F.when(F.col("_range") != "", F.when(wide, 4096).otherwise(256)).otherwise(F.pow(F.lit(10), F.length("_digits") - F.floor(F.length("_digits") / 2))).cast("long")
    high = F.when(F.col("_range") != "", F.when(wide, 4096).otherwise(256)).otherwise(F.pow(F.lit(10), F.floor(F.length("_digits") / 2))).cast("long")
    number = F.when(F.col("_range") != "", F.when(wide, octet(1) * 65536).otherwise(0) + octet(2) * 256 + octet(3)).otherwise(F.col("_digits").cast("long"))
    out = named.withColumn("_range", range_).withColumn("_digits", digits).withColumn("_low", low).withColumn("_high", high)
    out = out.withColumn("_number", number).withColumn("_left", F.expr("_number div _low")).withColumn("_right", F.expr("pmod(_number, _low)"))
    # the halves of each step: what is moved, by what, and within what
    steps = [("_left", "_right", "_high"), ("_right", "_left", "_low")] * 2
    by = lambda i, other: F.pmod(F.xxhash64(F.sha2(F.lit(f"{key}|{i}"), 256), "_kind", "_head", "_range", "_low", other), F.lit(1 << 40))
    for i, (half, other, size) in enumerate(steps):
        out = out.withColumn(half, F.pmod(F.col(half) + by(i, other), F.col(size)))
    out = out.withColumn("_number", F.expr("pmod(_left * _low + _right + 1, _low * _high)")).withColumn("_left", F.expr("_number div _low")).withColumn("_right", F.expr("pmod(_number, _low)"))
    for i, (half, other, size) in reversed(list(enumerate(steps))):
        out = out.withColumn(half, F.pmod(F.col(half) - by(i, other), F.col(size)))
    n = F.expr("_left * _low + _right")
    part = lambda by: F.pmod(F.floor(n / by), F.lit(256)).cast("string")
    address = F.concat("_range", F.when(wide, F.concat(part(65536), F.lit("."))).otherwise(""), part(256), F.lit("."), part(1))
    permuted = F.when(F.col("_range") != "", address).when(F.col("_digits").isNotNull(), F.concat("_head", F.lpad(n.cast("string"), F.length("_digits"), F.lit("0"))))
    return out.withColumn("_permuted", permuted).drop("_range", "_digits", "_low", "_high", "_number", "_left", "_right")


def draw(named: DataFrame, key: str) -> DataFrame:
    """(entity, nonce, target, permuted): the canonical form that stands for the canonical form `entity`, and whether it is of a permuted format."""
    value, stream = F.col("_value"), F.col("_stream")

    def pick(options: list[str], place: int | Column) -> Column:
        chosen = F.pmod(F.xxhash64(stream, F.lit("name"), F.lit(place)), F.lit(len(options))).cast("int")
        return F.get(F.array(*map(F.lit, options)), chosen)

    octet = lambda i: (1 + F.pmod(F.xxhash64(stream, F.lit(i)), F.lit(254))).cast("string")
    drawn = F.array_join(F.array(*map(octet, range(4))), ".")
    # an open address does not come to lie in a private or reserved range
    public = F.when(drawn.rlike(r"^(?:0|10|127|192|169|172)\."), F.concat(F.lit("203."), F.substring_index(drawn, ".", -3))).otherwise(drawn)
    # the last digit moves the remainder by as much as it changes, so that the wanted remainder can be met
    last = F.pmod(F.substring(F.col("_plain"), -1, 1).cast("int") + _luhn(value) - _luhn(F.col("_plain")), F.lit(10)).cast("string")
    syllables = F.transform(F.sequence(F.lit(1), F.lit(3) + F.floor(F.col("nonce") / 4).cast("int")), lambda i: pick(SYLLABLES, i))
    # a compound name gets as many parts, of which the first has the nonce's length
    parts = F.transform(F.split(value, "-"), lambda x, k: F.when(k == 0, F.initcap(F.array_join(syllables, ""))).otherwise(F.initcap(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2)), lambda i: pick(SYLLABLES, 100 * k + i)), ""))))
    name = F.array_join(parts, "-")
    listed = F.when(F.startswith(value, F.lit("f:")), pick(FEMALE_NAMES, 0)).when(F.startswith(value, F.lit("m:")), pick(MALE_NAMES, 0)).otherwise(pick([*MALE_NAMES, *FEMALE_NAMES], 0))
    # when the listed names are used up, others are made
    given = F.when(F.col("nonce") < 4, listed).otherwise(name)
    latin = value.rlike(r"^[mfn]:[\p{IsLatin}'’ -]+$")
    country, account = F.substring(value, 1, 2), F.expr("substring(_plain, 5)")
    what = F.col("_kind")
    longer = F.array_join(F.transform(F.sequence(F.lit(LONGER), F.greatest(F.col("nonce"), F.lit(LONGER))), lambda i: F.substring(F.lit("abcdef"), (F.pmod(F.xxhash64(stream, i), F.lit(6)) + 1).cast("int"), F.lit(1))), "")
    grown = F.when((F.col("nonce") >= LONGER) & what.isin("email", "secret", "cloud", "pem"), longer).otherwise("")
    target = (
        F.when(F.col("_permuted").isNotNull(), F.col("_permuted"))
        .when(what == "ip", public)
        .when(what == "iban", F.concat(country, F.lpad((98 - _mod97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0"), account))
        .when(what == "card", F.concat(F.expr("left(_plain, length(_plain) - 1)"), last))
        .when(what.isin("name", "given") & latin, F.concat(F.substring(value, 1, 2), F.when(what == "given", given).otherwise(name)))
        .otherwise(F.col("_plain"))
    )
    parsed = named.select("entity", "nonce").withColumn("_kind", F.substring_index("entity", ":", 1)).withColumn("_value", F.expr("substring(entity, length(_kind) + 2)")).withColumn("_head", _head(F.col("_kind"), F.col("_value")))
    return (
        _permuted(parsed, key)
        .withColumn("_tail", F.when(F.col("_kind") == "email", F.regexp_extract("_value", r"[.]\p{L}+$", 0)).otherwise(""))
        .withColumn("_stream", F.sha2(F.concat_ws("|", F.lit(key), F.col("nonce").cast("string"), F.col("entity")), 256))
        .withColumn("_plain", F.concat("_head", grown, _substituted(F.expr("substring(_value, length(_head) + 1, length(_value) - length(_head) - length(_tail))"), stream, what == "secret"), "_tail"))
        .select("entity", "nonce", F.concat(what, F.lit(":"), target).alias("target"), F.col("_permuted").isNotNull().alias("permuted"))
    )


def surrogates(found: DataFrame, key: str = KEY) -> DataFrame:
    """(entity, target) for the distinct `entity` of `found`; no two entities share a target, and outside permuted formats no target is an entity."""
    known = cut(found.select("entity").distinct())
    drawn = cut(draw(known.withColumn("nonce", F.lit(0)), key))
    real = known.select(F.col("entity").alias("target"), F.lit(True).alias("real"))
    for _ in range(ROUNDS):
        first = drawn.groupBy("target").agg(F.min(F.struct((~F.col("permuted")).alias("drawn"), "entity"))["entity"].alias("first"))
        checked = drawn.where(~F.col("permuted")).join(first, "target").join(real, "target", "left")
        lost = checked.where((F.col("entity") != F.col("first")) | F.col("real")).select("entity", (F.col("nonce") + 1).alias("nonce"))
        if lost.isEmpty():
            return drawn.select("entity", "target")
        drawn = cut(drawn.join(lost.select("entity"), "entity", "left_anti").unionByName(draw(lost, key)))
    raise RuntimeError(f"surrogates still collide after {ROUNDS} rounds")


def _written(mention: Column, target: Column) -> Column:
    """The target in the mention's format."""
    what = F.substring_index(target, ":", 1)
    bare = F.regexp_replace(target, "^[a-z]+:", "")
    digits = F.regexp_replace(bare, "[^0-9]", "")
    place = lambda i, unwanted: F.length(F.regexp_replace(F.substring(mention, F.lit(1), i + 1), unwanted, ""))
    spread = lambda chars, wanted, unwanted: F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike(wanted), F.substring(chars, place(i, unwanted), F.lit(1))).otherwise(c)), "")
    # a key keeps its name, a service's token and a private key what marks them
    name = F.regexp_extract(mention, f"^{_KEY_NAME}", 0)
    rest = F.substring(mention, F.length(name) + 1, F.length(mention))
    end = F.when(what == "pem", F.regexp_extract(mention, "(?:-----END[A-Z ]*-----)?$", 0)).otherwise("")
    # both are cut up once, so that a long secret costs no more a letter than a short one
    cased = F.array_join(F.zip_with(F.split(rest, ""), F.split(bare, ""), lambda c, x: F.when(c.rlike("[A-Z]"), F.upper(x)).otherwise(x)), "")
    kept = F.regexp_extract(rest, rf"^(?:{_SERVICE}|{_PEM})", 0)
    marked = F.when(what.isin("cloud", "pem"), F.concat(kept, F.substring(cased, F.length(kept) + 1, F.length(cased) - F.length(kept) - F.length(end)), end)).otherwise(cased)
    return (
        F.when(what.isin("phone", "card", "ssn"), spread(digits, "[0-9]", "[^0-9]")).when(what == "iban", spread(bare, "[A-Z0-9]", "[^A-Z0-9]"))
        .when(what.isin("secret", "cloud", "pem"), F.concat(name, marked)).when(what == "email", cased).when(what == "ip", bare)
    )


def _bare(target: Column) -> Column:
    return F.regexp_replace(target, "^[a-z]+:[mfn]:", "")


def _renamed(mention: Column, targets: Column) -> Column:
    """A titled name with the surrogate of each part; an initial becomes X, small words stay."""
    words = F.transform(_parts(mention), lambda x: F.when(x["form"].isNotNull(), _bare(F.element_at(targets, x["form"]))).when(x["word"].endswith("."), F.lit("X.")).otherwise(x["word"]))
    return F.concat(_title(mention), F.array_join(words, " "))


def _part(word: Column, targets: Column) -> Column:
    """What stands for a word that is part of a titled name of its document, or null."""
    known = F.coalesce(*[F.element_at(targets, F.concat(F.lit(k), word)) for k in ("name:n:", "given:m:", "given:f:", "given:n:")])
    return F.when(word.rlike(r"^\p{Lu}"), _bare(known))


def _untitled(words: Column, i: Column, targets: Column) -> Column:
    """The surrogate of the i-th of a text's words if it mentions a titled name of its document, or null.

    After an article, before another capital word that is part of no name, and, for a month, after a
    small word, it is no mention: the White House, in May.
    """
    word = lambda k: F.get(words, i + k)
    before, after = F.when(word(-1) == " ", word(-2)), F.when(word(1) == " ", word(2))
    other = F.coalesce(before.isin(ARTICLES), F.lit(False)) | (F.coalesce(after.rlike(r"^\p{Lu}"), F.lit(False)) & _part(after, targets).isNull()) | (word(0).isin(MONTHS) & F.coalesce(before.rlike(r"^\p{Ll}"), F.lit(False)))
    new = _part(word(0), targets)
    return F.when(new.isNotNull() & ~other, new)


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """`docs` with surrogates in `text`, and n_entities, the number of mentions that were replaced.

    Texts without an entity, null and empty texts stay as they are. Texts of any length are searched
    whole. A row's table of surrogates holds the entities of its own text, so that rows that repeat a
    doc_id, or have none, share nothing but equal texts. Equal entities get equal surrogates wherever
    they stand. The mark of a private key alone, or without its end and full lines, is no entity. Other
    columns stay, whatever their names; one named n_entities is replaced. An empty table gives an empty
    result.
    """
    columns = [c for c in docs.columns if c != "n_entities"]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    packed = packed.withColumn("id", F.col("row.doc_id")).withColumn("tid", text_hash("row.text"))
    mentions = packed.select("id", "tid", F.explode(F.array_distinct(F.flatten(F.transform(entities(F.col("row.text")), forms)))).alias("entity"))
    mentions = cut(mentions.distinct())
    known = mentions.join(surrogates(mentions, key), "entity").groupBy("id", "tid").agg(F.map_from_entries(F.collect_set(F.struct("entity", "target"))).alias("targets"))
    known = known.withColumnRenamed("id", "own").withColumnRenamed("tid", "own_tid")
    joined = packed.join(known, F.col("id").eqNullSafe(F.col("own")) & (F.col("tid") == F.col("own_tid")), "left").select("row", "targets")
    whole, targets = F.col("row.text"), F.col("targets")
    cut_up = joined.withColumn("mentions", F.when(targets.isNotNull(), entities(whole))).withColumn("between", F.when(F.size("mentions") > 0, F.split(whole, ANY, -1)))
    # only texts with a titled name are cut into words
    named = F.exists(F.map_keys(targets), lambda k: F.startswith(k, F.lit("name:")) | F.startswith(k, F.lit("given:")))
    cut_up = cut_up.withColumn("words", F.when(named & F.col("between").isNotNull(), F.transform("between", lambda x: F.regexp_extract_all(x, F.lit(_WORD), F.lit(0)))))
    cut_up = cut_up.withColumn("found", F.transform("words", lambda x: F.transform(x, lambda w, i: F.struct(w.alias("word"), _untitled(x, i, targets).alias("new")))))
    cut_up = cut_up.withColumn("between", F.when(F.col("found").isNotNull(), F.transform("found", lambda x: F.array_join(F.transform(x, lambda w: F.coalesce(w["new"], w["word"])), ""))).otherwise(F.col("between")))
    cut_up = cut_up.withColumn("more", F.coalesce(F.size(F.filter(F.flatten("found"), lambda w: w["new"].isNotNull())), F.lit(0)))
    aimed = F.transform("mentions", lambda x: F.struct(x["mention"].alias("mention"), x["kind"].alias("kind"), F.when(x["form"].isNotNull(), F.element_at(targets, x["form"])).alias("target")))
    new = lambda x: F.when(x["kind"] == "name", _renamed(x["mention"], targets)).when(x["kind"] == "none", x["mention"]).otherwise(_written(x["mention"], x["target"]))
    rest = F.transform(F.transform(aimed, new), lambda x, i: F.concat(x, F.get("between", i + 1)))
    text = F.when(F.col("between").isNotNull(), F.concat(F.get("between", F.lit(0)), F.array_join(rest, ""))).otherwise(whole)
    kept = [text.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in columns]
    return cut_up.select(*kept, F.coalesce(F.when(F.size("mentions") > 0, F.size(F.filter("mentions", lambda m: m["kind"] != "none")) + F.col("more")), F.lit(0)).cast("long").alias("n_entities"))


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(documents(spark, sf_dir)).select("doc_id", "text", "n_entities")


QUERIES = {"op7_pii_surrogates": op7_pii_surrogates}
ORACLES: dict[str, str] = {}
