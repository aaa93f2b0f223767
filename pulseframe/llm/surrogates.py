"""Surrogates for personal data, with DataFrame functions alone.

Entities are found by one pattern: e-mail and IPv4 addresses, card, account (IBAN), social security and phone numbers,
secrets (long hexadecimal strings and vendor keys) and names after a title. Each distinct entity gets a replacement
of its own kind, derived from a keyed hash:

* digits stay digits and punctuation stays, so numbers keep their format; phones keep the country code, accounts
  the country; secrets keep their alphabet and case;
* e-mail addresses get another local part in a reserved domain that follows from the old domain;
* names are built from syllables of the name's script, with an ending for the gender its titles tell. Given name and
  surname are replaced one by one, so "Ms. Ada Byron" and "Ms. Byron" still agree. A name found behind a title is
  replaced wherever its document has it as a whole word with a capital, before or after, with a title or bare.

The same entity gets the same surrogate in every document (phones and cards in whatever notation). A collision
check over all distinct entities keeps different ones apart and keeps surrogates clear of entities that occur: who
collides takes the hash of the next attempt, until none does. A format of digits (phones of one country and length,
cards, social security numbers, IPv4 addresses) that has more than one entity for ``FORMS`` forms is crowded: attempts
could run out there, so its entities are permuted by a keyed Feistel network that is one single cycle over all forms.
Distinctness holds by construction and no entity keeps its own text, but a crowded surrogate may be the text of another
entity that occurs. An entity is looked up, never a document, so hot values cost a skew join, which adaptive execution
splits; only documents with entities are shuffled.

Defined results: null and empty texts have no entity and stay; texts without entities stay to the letter; repeated
rows are rewritten alike; e-mail addresses that differ in case are one entity; a one-word name after a title is a
surname. ``n_entities`` is added (an input column of that name is replaced); all other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: The default key is for tests and benches; production gives its own.
KEY = "pulseframe-surrogates"
#: More attempts than any corpus needs; reaching the end is an error, not a silent collision.
ATTEMPTS = 16
#: A format with more than one entity for so many forms is permuted; below, an attempt collides less than once in eight.
FORMS = 16
#: Rounds of the Feistel network.
ROUNDS = 4

MALE = ["Mr", "Mister", "Herr", "Herrn", "Monsieur", "Señor", "господин", "Господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "госпожа", "Госпожа"]
NEUTRAL = ["Dr", "Prof"]

_EDGE, _STOP = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
_NAME = r"\p{Lu}[\p{L}'’-]{1,40}"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"
IBAN = _EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _STOP
CARD = r"(?<![\p{L}\p{N}+-])(?:(?:\d{4}[ -]?){3}\d{4}|3\d{3}[ -]?\d{6}[ -]?\d{5})" + _STOP
SSN = r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])"
PHONE = (
    r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}" + _STOP
    + r"|(?<![\p{L}\p{N}+])\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,4}" + _STOP
)
IP = r"(?<![\p{L}\p{N}.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![\p{L}\p{N}])(?!\.\d)"
SECRET = _EDGE + r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16}|(?:sk|pk|ghp|xoxb)[-_][A-Za-z0-9_-]{16,}+)" + _STOP
PERSON = _EDGE + rf"(?:{_TITLES})\.? {_NAME}(?: {_NAME})?"
PATTERN = "|".join([EMAIL, SECRET, IBAN, CARD, SSN, PHONE, IP, PERSON])
#: What every entity but a name holds; most texts are done with here.
HINT = rf"[0-9@]|{_EDGE}(?:{_TITLES})\.? |AKIA|(?:sk|pk|ghp|xoxb)[-_]"

_SYLLABLES = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу"), "greek": ("βγδζκλμνπρστ", "αεηιου")}
_ENDING = {"latin": ("n", "a", ""), "cyrillic": ("н", "я", ""), "greek": ("ς", "α", "")}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def entity_parts(match: Column) -> Column:
    """What a match consists of: array of (kind, value, canonical); kind null is text to keep."""

    def part(kind: Column | str | None, value: Column, canonical: Column | None = None) -> Column:
        kind = F.lit(kind).cast("string") if kind is None or isinstance(kind, str) else kind
        return F.struct(
            kind.alias("kind"), value.alias("value"), (F.lit(None).cast("string") if canonical is None else canonical).alias("canonical")
        )

    title = F.regexp_extract(match, rf"^((?:{_TITLES})\.? )", 1)
    bare = F.regexp_replace(title, r"[. ]", "")
    gender = F.when(bare.isin(MALE), "m").when(bare.isin(FEMALE), "f").otherwise("u")
    names = F.substr(match, F.length(title) + 1)
    given, surname = F.regexp_extract(names, r"^(\S+) \S+$", 1), F.regexp_extract(names, r"(\S+)$", 1)
    person = F.when(
        given != "",
        F.array(
            part(None, title), part(F.concat(F.lit("given:"), gender), given, F.lower(given)), part(None, F.lit(" ")),
            part("surname", surname, F.lower(surname)),
        ),
    ).otherwise(F.array(part(None, title), part("surname", surname, F.lower(surname))))
    country = F.regexp_extract(match, r"^(\+\d{1,3})", 1)
    phone = F.concat(country, F.lit("|"), _digits(F.substr(match, F.length(country) + 1)))
    return (
        F.when(match.contains("@"), F.array(part("email", match, F.lower(match))))
        .when(title != "", person)
        .when(match.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), F.array(part("ip", match, match)))
        .when(match.rlike(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA|(?:sk|pk|ghp|xoxb)[-_])"), F.array(part("secret", match, match)))
        .when(match.rlike(r"^[A-Z]{2}\d{2}"), F.array(part("iban", match, F.replace(match, F.lit(" "), F.lit("")))))
        .when(match.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.array(part("ssn", match, _digits(match))))
        .when(match.rlike(r"^[0-9 -]+$") & (F.length(_digits(match)) >= 15), F.array(part("card", match, _digits(match))))
        .otherwise(F.array(part("phone", match, phone)))
    )


def segments(text: Column) -> Column:
    """The text as an array of (kind, value, canonical) that spells it out."""
    plain, matches = F.split(text, PATTERN, -1), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    none = F.lit(None).cast("string")

    def both(literal: Column, match: Column) -> Column:
        keep = F.array(F.struct(none.alias("kind"), literal.alias("value"), none.alias("canonical")))
        return F.when(match.isNull(), keep).otherwise(F.concat(keep, entity_parts(match)))

    return F.flatten(F.zip_with(plain, matches, both))


def names_in(parts: Column, kind: str) -> Column:
    """Distinct names of a kind among the segments."""
    own = F.transform(F.filter(parts, lambda p: F.coalesce(p["kind"].startswith(kind), F.lit(False))), lambda p: p["canonical"])
    # behind a title "Byron's" is taken for a name; what is mentioned may be "Byron" alone
    return F.array_distinct(F.concat(own, F.transform(own, lambda n: F.regexp_replace(n, "(?<=.{2})['’]s?$", ""))))


def mention_pattern(surnames: Column, given: Column) -> Column:
    """What mentions of these names look like: whole words that begin with a capital, in whatever case else; null without names."""
    every = F.array_union(surnames, given)
    # names hold letters, apostrophes and hyphens alone; the longest is tried first
    ordered = F.reverse(F.array_sort(F.transform(every, lambda n: F.struct(F.length(n).alias("size"), n.alias("name")))))
    longest = F.array_join(F.transform(ordered, lambda x: x["name"]), "|")
    return F.when(F.size(every) > 0, F.concat(F.lit(_EDGE + r"(?=\p{Lu})(?iu:"), longest, F.lit(")" + _STOP)))


def with_mentions(parts: Column, surnames: Column, pattern: Column) -> Column:
    """Segments with every bare mention of the document's names as a segment of its own. A word that is both is a surname."""
    none = F.lit(None).cast("string")

    def both(literal: Column, match: Column) -> Column:
        kind = F.when(F.array_contains(surnames, F.lower(match)), "surname").otherwise("given:u")
        keep = F.struct(none.alias("kind"), literal.alias("value"), none.alias("canonical"))
        found = F.struct(kind.alias("kind"), match.alias("value"), F.lower(match).alias("canonical"))
        return F.when(match.isNull(), F.array(keep)).otherwise(F.array(keep, found))

    def one(part: Column) -> Column:
        cut = F.zip_with(F.split(part["value"], pattern, -1), F.regexp_extract_all(part["value"], pattern, F.lit(0)), both)
        return F.when(part["kind"].isNull(), F.flatten(cut)).otherwise(F.array(part))

    return F.when(pattern.isNotNull(), F.flatten(F.transform(parts, one))).otherwise(parts)


class _Stream:
    """Numbers 0-255 from a keyed hash of the entity and the attempt."""

    def __init__(self, key: str, kind: Column, canonical: Column, attempt: Column):
        # the gender of a given name only chooses its ending
        seed = F.concat_ws("\x1f", F.lit(key), F.substring_index(kind, ":", 1), canonical, attempt.cast("string"))
        first = F.sha2(seed, 512)
        self.hex = F.concat(first, F.sha2(first, 512))

    def at(self, i: Column | int) -> Column:
        i = F.lit(i) if isinstance(i, int) else i
        return F.conv(F.substr(self.hex, ((i * 2) % 256 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, n: Column) -> Column:
    return F.substr(F.lit(letters), (n % len(letters) + 1).cast("int"), F.lit(1))


def _alike(value: Column, stream: _Stream, lower: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """Every digit another digit, every letter another letter of its case; the rest stays."""

    def one(i: Column) -> Column:
        c = F.substr(value, i, F.lit(1))
        n = stream.at(i)
        return (
            F.when(c.rlike(r"\d"), _pick("0123456789", n)).when(c.rlike(r"\p{Lu}"), _pick(lower.upper(), n))
            .when(c.rlike(r"\p{L}"), _pick(lower, n)).otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(value), F.lit(1))), one), "")


def _name(canonical: Column, kind: Column, attempt: Column, stream: _Stream) -> Column:
    def built(script: str) -> Column:
        consonants, vowels = _SYLLABLES[script]
        male, female, neutral = _ENDING[script]
        body = F.array_join(
            F.transform(
                F.sequence(F.lit(0), attempt + 2), lambda i: F.concat(_pick(consonants, stream.at(i * 2)), _pick(vowels, stream.at(i * 2 + 1)))
            ), "",
        )
        ending = F.when(kind == "given:m", male).when(kind == "given:f", female).otherwise(neutral)
        return F.concat(body, ending)

    return (
        F.when(canonical.rlike(r"\p{IsCyrillic}"), built("cyrillic")).when(canonical.rlike(r"\p{IsGreek}"), built("greek")).otherwise(built("latin"))
    )


def surrogate(kind: Column, canonical: Column, attempt: Column, key: str) -> Column:
    """Replacement of a canonical entity, in canonical notation."""
    s = _Stream(key, kind, canonical, attempt)
    local, domain = F.substring_index(canonical, "@", 1), F.substring_index(canonical, "@", -1)
    # further attempts lengthen a local part that has too few forms
    email = F.concat(
        _alike(local, s), F.when(attempt > 1, F.substr(s.hex, F.lit(1), attempt)).otherwise(""),
        F.lit("@d"), F.substr(F.sha2(F.concat(F.lit(key), domain), 256), F.lit(1), F.lit(10)), F.lit(".example.org"),
    )
    ip = F.concat_ws(
        ".", (s.at(0) % 223 + 1).cast("string"), s.at(1).cast("string"), s.at(2).cast("string"), (s.at(3) % 254 + 1).cast("string")
    )
    hexadecimal = canonical.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")
    prefix = F.regexp_extract(canonical, r"^(AKIA|(?:sk|pk|ghp|xoxb)[-_])", 1)
    secret = F.when(hexadecimal, _alike(canonical, s, "abcdef")).otherwise(
        F.concat(prefix, _alike(F.substr(canonical, F.length(prefix) + 1), s))
    )
    country = F.substring_index(canonical, "|", 1)
    phone = F.concat(country, F.lit("|"), _alike(F.substring_index(canonical, "|", -1), s))
    iban = F.concat(F.substr(canonical, F.lit(1), F.lit(2)), _alike(F.substr(canonical, F.lit(3)), s))
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "secret", secret).when(kind == "phone", phone)
        .when(kind == "iban", iban).when(kind.isin("card", "ssn"), _alike(canonical, s)).otherwise(_name(canonical, kind, attempt, s))
    )


def in_format(kind: Column, value: Column, found: Column) -> Column:
    """A canonical surrogate in the notation of the value it replaces."""
    country = F.when(kind == "phone", F.substring_index(found, "|", 1)).otherwise("")
    plain = F.when(kind == "phone", F.substring_index(found, "|", -1)).otherwise(found)
    rest = F.substr(value, F.length(country) + 1)

    def one(i: Column) -> Column:
        c = F.substr(rest, i, F.lit(1))
        taken = F.length(F.regexp_replace(F.substr(rest, F.lit(1), i), r"[^\p{L}\p{N}]", ""))
        return F.when(c.rlike(r"[\p{L}\p{N}]"), F.substr(plain, taken, F.lit(1))).otherwise(c)

    overlaid = F.concat(country, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(rest), F.lit(1))), one), ""))
    named = F.when((F.length(value) > 1) & (value == F.upper(value)), F.upper(found)).otherwise(F.initcap(found))
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), overlaid).when(kind.startswith("given") | (kind == "surname"), named).otherwise(found)
    )


def number_format(kind: Column, canonical: Column) -> Column:
    """Name of an entity's format of digits; null for kinds whose surrogates lengthen, or that have forms beyond count."""
    size = F.length(F.substring_index(canonical, "|", -1)).cast("string")
    return (
        F.when(kind == "phone", F.concat_ws("|", kind, F.substring_index(canonical, "|", 1), size))
        .when(kind.isin("card", "ssn"), F.concat_ws("|", kind, size)).when(kind == "ip", kind)
    )


def forms_of(kind: Column, canonical: Column) -> Column:
    """How many entities a format of digits can spell."""
    return F.when(kind == "ip", F.lit(2.0**32)).otherwise(F.pow(F.lit(10.0), F.length(F.substring_index(canonical, "|", -1))))


def permuted(kind: Column, canonical: Column, key: str) -> Column:
    """Surrogate of an entity of a crowded format: the next form on one keyed cycle through all forms.

    A Feistel network numbers the forms; one is added to an entity's number and the network undone. So each form has a
    successor of its own, which is never itself.
    """
    ip, digits = kind == "ip", F.substring_index(canonical, "|", -1)
    half = F.floor(F.length(digits) / 2).cast("int")
    octet = F.split(F.when(ip, canonical).otherwise("0.0.0.0"), r"\.")
    left, right = (
        F.when(ip, octet[2 * k].cast("long") * 256 + octet[2 * k + 1].cast("long")).otherwise(F.coalesce(part.try_cast("long"), F.lit(0).cast("long")))
        for k, part in enumerate((F.substr(digits, F.lit(1), half), F.substr(digits, half + 1)))
    )
    most = [F.when(ip, 65536).otherwise(F.pow(F.lit(10.0), size)).cast("long") for size in (half, F.length(digits) - half)]

    def noise(side: str, round_: Column, value: Column) -> Column:
        seed = F.concat_ws("\x1f", F.lit(key), F.lit(side), number_format(kind, canonical), round_.cast("string"), value.cast("string"))
        return F.conv(F.substr(F.sha2(seed, 256), F.lit(1), F.lit(15)), 16, 10).cast("long")

    def state(a: Column, b: Column) -> Column:
        return F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def forth(s: Column, i: Column) -> Column:
        a = F.pmod(s["a"] + noise("a", i, s["b"]), most[0])
        return state(a, F.pmod(s["b"] + noise("b", i, a), most[1]))

    def back(s: Column, i: Column) -> Column:
        b = F.pmod(s["b"] - noise("b", i, s["a"]), most[1])
        return state(F.pmod(s["a"] - noise("a", i, b), most[0]), b)

    def undone(s: Column) -> Column:
        carried = s["b"] + 1 == most[1]
        following = state(F.when(carried, F.pmod(s["a"] + 1, most[0])).otherwise(s["a"]), F.when(carried, 0).otherwise(s["b"] + 1))
        return F.aggregate(F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)), following, back, spelt)

    def spelt(s: Column) -> Column:
        a, b = s["a"], s["b"]
        address = F.concat_ws(".", *[x.cast("string") for x in (F.floor(a / 256), a % 256, F.floor(b / 256), b % 256)])
        number = F.concat(F.lpad(a.cast("string"), half, "0"), F.lpad(b.cast("string"), F.length(digits) - half, "0"))
        # one digit alone has no left half
        return F.when(ip, address).when(half > 0, number).otherwise(b.cast("string"))

    found = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state(left, right), forth, undone)
    return F.when(kind == "phone", F.concat_ws("|", F.substring_index(canonical, "|", 1), found)).otherwise(found)


def mapping(entities: DataFrame, key: str = KEY, attempts: int = ATTEMPTS) -> DataFrame:
    """Distinct (kind, canonical) with their surrogates, all distinct and, but in crowded formats, none an entity that occurs.

    A given name is one entity, whatever its titles: its gender is that of the titles that tell one, and open where
    none does or they differ.
    """
    kind, canonical = F.col("kind"), F.col("canonical")
    found = entities.groupBy(F.substring_index("kind", ":", 1).alias("base"), "canonical").agg(
        F.max(kind == "given:m").alias("m"), F.max(kind == "given:f").alias("f")
    )
    gender = F.when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("u")
    named = common.written(
        found.select(F.when(F.col("base") == "given", F.concat(F.lit("given:"), gender)).otherwise(F.col("base")).alias("kind"), "canonical", F.lit(0).alias("attempt")),
        "entities",
    )
    # countries and lengths are few (less than 20 000 formats), so the crowded ones are broadcast
    crowded = named.withColumn("format", number_format(kind, canonical)).filter("format is not null").groupBy("format").agg(
        F.count(F.lit(1)).alias("n"), F.max(forms_of(kind, canonical)).alias("forms")
    ).filter(F.col("n") * FORMS > F.col("forms")).select("format")
    crowded = common.written(crowded, "crowded")
    cycled = named.limit(0).select("kind", "canonical", F.lit("").alias("surrogate"))
    if not crowded.isEmpty():
        keyed, formats = named.withColumn("format", number_format(kind, canonical)), F.broadcast(crowded)
        cycled = keyed.join(formats, "format").select("kind", "canonical", permuted(kind, canonical, key).alias("surrogate"))
        named = common.written(keyed.join(formats, "format", "left_anti").drop("format"), "entities")
    for _ in range(attempts):
        tried = named.withColumn("surrogate", surrogate(kind, canonical, F.col("attempt"), key))
        claims = tried.select("kind", "canonical", "attempt", "surrogate", F.col("surrogate").alias("claimed")).unionByName(
            named.select("kind", "canonical", F.lit(-1).alias("attempt"), F.lit(None).cast("string").alias("surrogate"), canonical.alias("claimed"))
        )
        # an entity that occurs owns its own text, then the earliest attempt, then the first entity
        group = Window.partitionBy(F.substring_index("kind", ":", 1), "claimed").orderBy("attempt", "kind", "canonical")
        ranked = claims.withColumn("place", F.row_number().over(group)).filter(F.col("surrogate").isNotNull())
        settled = common.written(ranked.withColumn("collides", F.col("place") > 1).drop("claimed", "place"), "surrogates")
        if settled.filter("collides").isEmpty():
            return settled.select("kind", "canonical", "surrogate").unionByName(cycled)
        named = settled.select("kind", "canonical", (F.col("attempt") + F.col("collides").cast("int")).alias("attempt"))
    raise ValueError(f"surrogates still collide after {attempts} attempts")


def _fresh(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def replace_entities(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """Rewrite ``text`` and add ``n_entities``."""
    docs = docs.drop("n_entities")
    body = F.col(f"`{text}`")
    # nested conditions, as a conjunction of two patterns may be evaluated in either order
    has = F.coalesce(F.when(body.rlike(HINT), body.rlike(PATTERN)).otherwise(False), F.lit(False))
    row, parts, surnames, given, pattern = (_fresh(docs, x) for x in ("row_", "parts_", "surnames_", "given_", "pattern_"))
    split = docs.filter(has).withColumn(row, F.monotonically_increasing_id()).withColumn(parts, segments(body))
    # columns of their own, so that each is worked out once a row and not once a segment
    split = split.withColumns({surnames: names_in(F.col(parts), "surname"), given: names_in(F.col(parts), "given")})
    split = split.withColumn(pattern, mention_pattern(F.col(surnames), F.col(given)))
    split = split.withColumn(parts, with_mentions(F.col(parts), F.col(surnames), F.col(pattern)))
    with_ = common.written(split.drop(surnames, given, pattern), "with-entities")
    one = with_.select(F.col(row).alias("row"), F.posexplode(parts).alias("at", "part")).filter("part.kind is not null").select(
        "row", "at", "part.kind", "part.value", "part.canonical"
    )
    base = F.substring_index("kind", ":", 1)
    looked_up = one.withColumn("kind", base).join(mapping(one, key).withColumn("kind", base), ["kind", "canonical"]).select(
        "row", F.struct("at", in_format(F.col("kind"), F.col("value"), F.col("surrogate")).alias("new")).alias("change")
    )
    changes = looked_up.groupBy("row").agg(F.map_from_entries(F.collect_list("change")).alias("changes"))
    joined = with_.join(changes.withColumnRenamed("row", row), row)
    new = F.array_join(F.transform(F.col(parts), lambda p, i: F.coalesce(F.element_at("changes", i), p["value"])), "")
    rewritten = joined.withColumn(text, new).withColumn("n_entities", F.size("changes").cast("long"))
    untouched = docs.filter(~has).withColumn("n_entities", F.lit(0).cast("long"))
    return rewritten.select(*untouched.columns).unionByName(untouched)


def query(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    return replace_entities(docs.select("doc_id", "text"))


def protect(docs: DataFrame) -> DataFrame:
    """Pipeline stage: every document stays, its entities replaced."""
    return replace_entities(docs).select(*docs.columns)
