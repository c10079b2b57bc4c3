"""Surrogates for personal data, in DataFrame functions only.

Entities are e-mail addresses, phone numbers, IPv4 addresses, payment cards, social
security numbers and names behind a title. Each distinct entity gets one replacement
for the whole collection, derived from a key by sha-256:

* of its type and format: letters for letters, digits for digits, case, punctuation and
  length kept; valid octets; a card keeps its first digit and ends in a right check
  digit; a phone number keeps its country code; equal mail domains stay equal and
  different ones different; where names or addresses fill their format they get longer,
  while numbers that do so end the job;
* names follow the gender of the title (endings) and the script of the name (Latin or
  Cyrillic syllables); given and family names are replaced apart, so "Ms Ann Lee" and
  "Ms Lee" keep the family name they share;
* coreference: spellings of one entity (case of an address, punctuation or country
  code of a number) share one canonical form and so one replacement;
* distinctness: replacements are compared over the whole collection; of entities with
  equal ones, and of those whose replacement is an entity itself, all but the first
  draw again until none is left.

Only texts with an entity are moved. Entities are made distinct per task before the
shuffle; a frequent one is split by Spark's skew join when it is looked up.

Defined results: null texts stay null and empty ones empty; repeated and null ids are
answered row by row; other columns pass unchanged; an empty table gives none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavecount.session import materialise

# Titles by the gender they tell.
MALE = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Sir", "Господин", "господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Sra", "Doña", "Lady", "Госпожа", "госпожа")
NEUTRAL = ("Dr", "Prof", "Mx")
_TITLE = "|".join((*MALE, *FEMALE, *NEUTRAL))

# Patterns of entities, tried in this order at each place.
_EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IP = rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)"
_SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
_CARD = r"(?<![\w+-])(?:\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}|[3-6]\d{12,18})(?![\w-])"
_PHONE = (r"(?<![\w+.-])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
          r"|(?:\(\d{2,4}\) ?|\d{3,4}[ .-])\d{3,4}[ .-]\d{3,4})(?![\w-])")
# the capital comes first, so that titles are looked for behind capitals alone
_NAME = rf"\p{{Lu}}(?<=(?<!\p{{L}})(?:{_TITLE})\.? \p{{Lu}})[\p{{L}}'’-]+(?: \p{{Lu}}[\p{{L}}'’-]+)?"
PATTERN = "|".join((_EMAIL, rf"(?=[\d+(])(?:{_IP}|{_SSN}|{_CARD}|{_PHONE})", _NAME))
#: What every entity has, one or the other; cheap tests before the pattern.
_HINTS = ("[@0-9]", rf"(?<!\p{{L}})(?=[{''.join(sorted({t[0] for t in (*MALE, *FEMALE, *NEUTRAL)}))}])(?:{_TITLE})\.? \p{{Lu}}")

_VOWELS, _CONSONANTS = "aeiou", "bdfghklmnprstvz"
_CYR_VOWELS, _CYR_CONSONANTS = "аеиоу", "бвгдклмнпрст"
ROUNDS = 40


def _anchored(pattern: str) -> str:
    return f"^(?:{pattern})$"


def _kind(raw: Column) -> Column:
    return (F.when(raw.contains("@"), "email").when(raw.rlike(_anchored(_IP)), "ip").when(raw.rlike(_anchored(_SSN)), "ssn")
            .when(raw.rlike(_anchored(_CARD)), "card").when(raw.rlike(r"\d"), "phone").otherwise("name"))


def _canon(kind: Column, raw: Column) -> Column:
    digits = F.regexp_replace(raw, r"\D", "")
    return (F.when(kind == "phone", F.when(F.length(digits) > 10, F.substring(digits, -10, 10)).otherwise(digits))
            .when(kind.isin("card", "ssn"), digits).otherwise(F.lower(raw)))


def _stream(key: str, *seed: Column) -> Column:
    """Hexadecimal digits without end in practice: two for each of 96 places, by a keyed hash."""
    parts = [F.sha2(F.concat_ws("|", F.lit(key), *[s.cast("string") for s in seed], F.lit(str(k))), 256) for k in range(3)]
    return F.concat(*parts)


def _octet(stream: Column, place: Column) -> Column:
    return F.conv(F.substring(stream, F.pmod(place - 1, F.lit(96)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, number: Column) -> Column:
    return F.substring(F.lit(letters), F.pmod(number, F.lit(len(letters))) + 1, F.lit(1))


def _each(value: Column, change) -> Column:
    """Every character of ``value`` through ``change(character, place)``; an empty value stays empty."""
    places = F.when(F.length(value) > 0, F.sequence(F.lit(1), F.length(value))).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: change(F.substring(value, i, F.lit(1)), i)), "")


def _masked(value: Column, stream: Column) -> Column:
    """Letters for letters of their script, digits for digits, the rest as it is."""
    def change(c: Column, i: Column) -> Column:
        n = _octet(stream, i)
        return (F.when(c.rlike(r"\d"), F.pmod(n, F.lit(10)).cast("string"))
                .when(c.rlike(r"\p{IsCyrillic}"), _pick("абвгдежзиклмнопрстуфхцчшщыэюя", n))
                .when(c.rlike(r"\p{L}"), _pick("abcdefghijklmnopqrstuvwxyz", n)).otherwise(c))

    return _each(value, change)


def _roomier(value: Column, attempt: Column) -> Column:
    """One more letter after every fourth draw, so that a full format ends no search."""
    return F.concat(value, F.repeat(F.lit("a"), F.floor(attempt / 4).cast("int")))


def _email(canon: Column, key: str, attempt: Column, host: Column) -> Column:
    """An address at ``host``, the replacement of its domain."""
    local = _roomier(F.substring_index(canon, "@", 1), attempt)
    return F.concat(_masked(local, _stream(key, F.lit("email"), canon, attempt)), F.lit("@"), host)


def _domain(canon: Column, key: str, attempt: Column) -> Column:
    """A domain under the same top."""
    top = F.substring_index(canon, ".", -1)
    name = _roomier(F.substring(canon, F.lit(1), F.length(canon) - F.length(top) - 1), attempt)
    return F.concat(_masked(name, _stream(key, F.lit("domain"), canon, attempt)), F.lit("."), top)


def _digits(canon: Column, stream: Column, first: Column) -> Column:
    """As many digits as ``canon`` has; ``first`` gives the leading one."""
    return _each(canon, lambda c, i: F.when(i == 1, first).otherwise(F.pmod(_octet(stream, i), F.lit(10)).cast("string")))


def _check_digit(body: Column) -> Column:
    """The digit that makes a card number valid (Luhn)."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(body, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(F.pmod(F.length(body) - i, F.lit(2)) == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(body)), F.lit(0), add)
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def _name(kind: Column, canon: Column, stream: Column, attempt: Column) -> Column:
    """Syllables of the name's script, about as long as it, ending by gender."""
    cyrillic = canon.rlike(r"\p{IsCyrillic}")
    pairs = F.greatest(F.lit(1), F.floor(F.length(canon) / 2) - 1).cast("int") + F.floor(attempt / 8).cast("int")

    def syllables(vowels: str, consonants: str) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), pairs), lambda i: F.concat(
            _pick(consonants, _octet(stream, i * 2)), _pick(vowels, _octet(stream, i * 2 + 1)))), "")

    latin_end = F.when(kind == "given_f", _pick("a", F.lit(0))).when(kind == "given_m", _pick("nrsd", _octet(stream, F.lit(1)))).otherwise(
        _pick("klmt", _octet(stream, F.lit(1))))
    cyr_end = F.when(kind == "given_f", F.lit("а")).when(kind == "given_m", _pick("нрсй", _octet(stream, F.lit(1)))).otherwise(
        F.when(kind == "family_f", F.lit("ова")).otherwise(F.lit("ов")))
    last = F.when(kind == "given_f", F.lit("n")).otherwise(F.lit(""))
    return F.when(cyrillic, F.concat(syllables(_CYR_VOWELS, _CYR_CONSONANTS), F.when(kind == "given_f", F.lit("н")).otherwise(F.lit("")), cyr_end)).otherwise(
        F.concat(syllables(_VOWELS, _CONSONANTS), last, latin_end))


def _surrogate(key: str) -> Column:
    """The replacement of the canonical form in columns kind, canon, attempt and, for addresses, host."""
    kind, canon, attempt = F.col("kind"), F.col("canon"), F.col("attempt")
    stream = _stream(key, kind, canon, attempt)
    octets = F.array_join(F.array(*[(F.pmod(_octet(stream, F.lit(k)), F.lit(254)) + 1).cast("string") for k in range(1, 5)]), ".")
    body = _digits(F.substring(canon, F.lit(1), F.length(canon) - 1), stream, F.substring(canon, 1, 1))
    nonzero = (F.pmod(_octet(stream, F.lit(1)), F.lit(8)) + 2).cast("string")
    return (F.when(kind == "email", _email(canon, key, attempt, F.col("host"))).when(kind == "domain", _domain(canon, key, attempt))
            .when(kind == "ip", octets)
            .when(kind == "card", F.concat(body, _check_digit(body))).when(kind.isin("phone", "ssn"), _digits(canon, stream, nonzero))
            .otherwise(_name(kind, canon, stream, attempt)))


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon and a surrogate which no other entity of the kind has and which is no entity itself.

    Domains of addresses are entities of their own and come first; addresses then differ
    within a domain.
    """
    host = F.when(F.col("kind") == "email", F.substring_index("canon", "@", -1))
    named = entities.select("kind", "canon", host.alias("domain"))
    domains = named.where("kind = 'email'").select(F.lit("domain").alias("kind"), F.col("domain").alias("canon")).distinct()
    hosts = _drawn(domains.withColumn("host", F.lit(None).cast("string")), key)
    hosts = hosts.select(F.col("canon").alias("domain"), F.col("surrogate").alias("host"))
    return _drawn(named.join(hosts, "domain", "left").select("kind", "canon", "host"), key)


def _drawn(entities: DataFrame, key: str) -> DataFrame:
    """Every round looks at all replacements at once and draws anew for the losers only."""
    # a number given, so that few octets of entities are not put into one task of much work
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = entities.repartition(tasks, "kind", "canon").withColumn("attempt", F.lit(0))
    drawn = materialise(spread.withColumn("surrogate", _surrogate(key)), "surrogates")
    originals = drawn.select("kind", F.col("canon").alias("surrogate"))
    for _ in range(ROUNDS):
        shared = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("keeper"), F.count("*").alias("n")).where("n > 1")
        twice = drawn.join(shared, ["kind", "surrogate"]).where(F.col("canon") != F.col("keeper")).select("kind", "canon")
        real = drawn.join(originals, ["kind", "surrogate"], "left_semi").select("kind", "canon")
        losers = materialise(twice.union(real).distinct().withColumn("again", F.lit(1)), "losers")
        if losers.isEmpty():
            return drawn.select("kind", "canon", "surrogate")
        marked = drawn.join(losers, ["kind", "canon"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0)))
        new = F.when(F.col("again").isNotNull(), _surrogate(key)).otherwise(F.col("surrogate"))
        drawn = materialise(marked.select("kind", "canon", "host", "attempt", new.alias("surrogate")), "surrogates")
    raise ValueError("more numbers of a kind than its format has room for")


def _dressed(kind: Column, raw: Column, surrogate: Column) -> Column:
    """The replacement in the spelling of this mention: its punctuation, country code and case."""
    digits = F.regexp_replace(raw, r"\D", "")
    full = F.concat(F.substring(digits, F.lit(1), F.length(digits) - F.length(surrogate)), surrogate)
    numbered = _each(raw, lambda c, i: F.when(c.rlike(r"\d"), F.substring(
        full, F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), r"\D", "")), F.lit(1))).otherwise(c))
    cased = _each(surrogate, lambda c, i: F.when(F.substring(raw, i, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c))
    shouted = (F.length(raw) > 1) & (raw == F.upper(raw))
    name = F.when(shouted, F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return F.when(kind.isin("phone", "card", "ssn"), numbered).when(kind == "email", cased).when(kind == "ip", surrogate).otherwise(name)


def _mentions(found: DataFrame) -> DataFrame:
    """One row per mention, or per part of a name, in the order of the text."""
    mention = found.select("row", F.posexplode(F.arrays_zip("raws", "before")).alias("pos", "m"))
    mention = mention.select("row", "pos", F.col("m.raws").alias("raw"), F.regexp_extract("m.before", rf"({_TITLE})\.? $", 1).alias("title"))
    kind = _kind(F.col("raw"))
    sex = F.when(F.col("title").isin(*MALE), "m").when(F.col("title").isin(*FEMALE), "f").otherwise("x")
    mention = mention.withColumn("kind", kind).withColumn("sex", sex)
    parts = F.when(F.col("kind") == "name", F.split("raw", " ")).otherwise(F.array("raw"))
    mention = mention.select("row", "pos", "kind", "sex", F.size(parts).alias("n"), F.posexplode(parts).alias("sub", "raw"))
    is_given = (F.col("n") == 2) & (F.col("sub") == 0)
    cyrillic_f = F.col("raw").rlike(r"\p{IsCyrillic}") & (F.col("sex") == "f")
    named = F.when(is_given, F.concat(F.lit("given_"), F.col("sex"))).when(cyrillic_f, "family_f").otherwise("family")
    mention = mention.withColumn("kind", F.when(F.col("kind") == "name", named).otherwise(F.col("kind")))
    return mention.select("row", "pos", "sub", "kind", "raw", _canon(F.col("kind"), F.col("raw")).alias("canon"))


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced, and ``n_entities`` beside it."""
    plain = docs.drop("n_entities")
    hinted = F.col("text").rlike(_HINTS[0]) | F.col("text").rlike(_HINTS[1])
    hit = F.coalesce(hinted & F.col("text").rlike(PATTERN), F.lit(False))
    whole = F.struct(*[F.col(f"`{c}`") for c in plain.columns])
    parts = F.split("text", PATTERN, -1)
    found = plain.where(hit).select(
        F.monotonically_increasing_id().alias("row"), whole.alias("doc"), parts.alias("parts"),
        F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("raws"))
    # written once, so the row numbers hold in all that follows
    found = materialise(found.withColumn("before", F.transform("parts", lambda p: F.substring(p, -16, 16))), "mentions")
    mentions = _mentions(found.select("row", "raws", F.slice("before", F.lit(1), F.size("raws")).alias("before")))
    table = distinct_surrogates(mentions.select("kind", "canon").distinct(), key)
    told = mentions.join(table, ["kind", "canon"]).select(
        "row", "pos", "sub", _dressed(F.col("kind"), F.col("raw"), F.col("surrogate")).alias("value"))
    told = told.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "sub", "value"))).alias("told"))
    pieces = F.transform("told", lambda t: F.concat(
        F.when(t["sub"] == 0, F.get("parts", t["pos"])).otherwise(F.lit(" ")), t["value"]))
    text = F.concat(F.array_join(pieces, ""), F.element_at("parts", -1))
    fields = [text.alias(c) if c == "text" else F.col("doc")[c].alias(c) for c in plain.columns]
    changed = found.join(told, "row").select(*fields, F.size("raws").cast("long").alias("n_entities"))
    return plain.where(~hit).withColumn("n_entities", F.lit(0).cast("long")).unionByName(changed)
