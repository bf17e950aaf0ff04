"""Replace personal data by keyed surrogates of the same type, all in Spark expressions.

Entities are found by patterns. An entity's parts (a number, an address, a given name, a
surname) have a canonical form, without the separators, letter case or country code that
may differ between mentions. A part's surrogate follows from a secret key, its kind, its
canonical form and an attempt number, so every mention of it, in whatever document and
format, gets the same one, written in the mention's own format: separators, length, script,
the gender of the title, a card's check digit.

Attempts are 0 but for collisions. All distinct parts and their surrogates are compared:
where two parts share a surrogate, or a surrogate is some real part, the first keeps it and
the others try the next attempt, until none is left. From attempt ``_LONGER`` on a surrogate
is longer than the part by the attempt's digits, so that no two attempts can meet and the
surrogates of a kind never run out. The few parts with later attempts are joined to the
documents that mention them. Texts without entities come out unchanged.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.llm.common import cut_lineage, unused

# Titles by the gender they tell.
MALE = ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа")
EITHER = ("Dr", "Prof")

_NAME = r"\p{Lu}\p{L}{1,40}(?:[-'’]\p{Lu}?\p{L}{1,40})?"
_TITLE = rf"(?:{'|'.join((*MALE, *FEMALE, *EITHER))})\.?[ \u00a0]"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Kinds of entities in order of precedence.
PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]{1,64}@(?:[\p{L}\d-]{1,63}\.){1,8}\p{L}{2,24}",
    "secret": (
        r"(?i:(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key))"
        r"""[ \t]{0,3}[=:][ \t]{0,3}["']?[A-Za-z0-9+/_.~$!@#%^&*-]{5,}[A-Za-z0-9+/_~$@#%^&*-]"""
    ),
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "card": (
        r"(?<![\w.-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])"
    ),
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": (
        r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
        r"|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\w-])"
    ),
    "person": rf"(?<!\p{{L}}){_TITLE}{_NAME}(?:[ \u00a0]{_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_VALUE = r"""^(.*?[=:][ \t]{0,3}["']?)(.*)$"""
_PERSON = rf"^({_TITLE})({_NAME})([ \u00a0]?)({_NAME})?$"

# Syllables of surrogate names by script, and how given names end by gender.
_SYLLABLES = {
    "latin": "ba be bri da del fa fen gar ha hol ka kel lo mar mi nor pa ros sel ta ti vor wen".split(),
    "cyrillic": "ба бел вар гор да дем жа зол ка кор ла лев мар ми нор пав ро сел та тих фад".split(),
}
_ENDINGS = {
    "given_m": {"latin": "n", "cyrillic": "н"},
    "given_f": {"latin": "na", "cyrillic": "на"},
    "given_e": {"latin": "li", "cyrillic": "ли"},
    "surname_m": {"latin": "man", "cyrillic": "ов"},
    "surname_f": {"latin": "man", "cyrillic": "ова"},
    "surname_e": {"latin": "man", "cyrillic": "ко"},
}
#: Attempts after which surrogates get longer.
_LONGER = 12


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """Name a value inside an expression, so that it is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _kind(entity: Column) -> Column:
    found = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        found = F.when(F.regexp_like(entity, F.lit(f"^(?:{pattern})$")), kind).otherwise(found)
    return found


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _national(digits: Column) -> Column:
    """A number of the North American plan without its country code."""
    long = (F.length(digits) == 11) & digits.startswith("1")
    return F.when(long, F.substr(digits, F.lit(2))).otherwise(digits)


def _gender(title: Column) -> Column:
    bare = F.regexp_replace(title, r"[. \u00a0]", "")
    return F.when(bare.isin(*MALE), "m").when(bare.isin(*FEMALE), "f").otherwise("e")


def parts(entity: Column) -> Column:
    """(kind, real) of what an entity consists of; names are two parts."""

    def part(kind: Column, real: Column) -> Column:
        return F.struct(kind.alias("kind"), real.alias("real"))

    def name(group: int, kind: str) -> Column:
        real = F.lower(F.regexp_extract(entity, _PERSON, group))
        # One surname is one part whoever bears it; its ending follows the mention.
        gender = _gender(F.regexp_extract(entity, _PERSON, 1))
        told = F.concat(F.lit("given_"), gender) if kind == "given" else F.lit("surname")
        return part(told, real)

    def of(kind: Column) -> Column:
        real = (
            F.when(kind == "email", F.lower(entity))
            .when(kind == "secret", F.regexp_extract(entity, _VALUE, 2))
            .when(kind == "phone", _national(_digits(entity)))
            .when(kind.isin("card", "ssn"), _digits(entity))
            .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
            .otherwise(entity)
        )
        both = F.regexp_extract(entity, _PERSON, 4) != ""
        return (
            F.when(
                kind == "person",
                F.when(both, F.array(name(2, "given"), name(4, "surname"))).otherwise(
                    F.array(name(2, "surname"))
                ),
            )
            .otherwise(F.array(part(kind, real)))
        )

    return _let(_kind(entity), of)


def _byte(digest: Column, i: Column) -> Column:
    """Byte i, from 1, of a digest in hexadecimal digits; it repeats after 64 bytes."""
    at = ((i - 1) % 64) * 2 + 1
    return F.conv(F.substr(digest, at, F.lit(2)), 16, 10).cast("int")


def _scrambled(value: Column, digest: Column, first: int = 0) -> Column:
    """Each letter or digit after the first ``first`` characters becomes another of its
    class; hexadecimal values stay hexadecimal."""
    letters = F.when(F.regexp_like(value, F.lit("^[0-9a-f]+$")), 6).otherwise(26)

    def swap(char: Column, place: Column) -> Column:
        i = place + 1
        byte = _byte(digest, i)
        lower = F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), byte % letters + 1, F.lit(1))
        return (
            F.when(i <= first, char)
            .when(F.regexp_like(char, F.lit("[0-9]")), (byte % 10).cast("string"))
            .when(F.regexp_like(char, F.lit(r"\p{Lu}")), F.upper(lower))
            .when(F.regexp_like(char, F.lit(r"\p{L}")), lower)
            .otherwise(char)
        )

    # Cut once: taking each character from the whole would cost the square of the length.
    return F.array_join(F.transform(F.split(value, ""), swap), "")


def _luhn(digits: Column) -> Column:
    """The check digit that belongs after ``digits``."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return (10 - total % 10) % 10


def _card(real: Column, digest: Column, tail: Column) -> Column:
    """First digit kept; the check digit is right if and only if the real one is."""
    body = lambda x: F.substr(x, F.lit(1), F.length(x) - 1)
    off = F.pmod(F.substr(real, F.length(real), F.lit(1)).cast("int") - _luhn(body(real)), F.lit(10))
    return _let(
        F.concat(body(_scrambled(real, digest, 1)), tail),
        lambda new: F.concat(new, ((_luhn(new) + off) % 10).cast("string")),
    )


def _syllables(real: Column, digest: Column, attempt: Column) -> Column:
    """Three syllables in the name's script, more after many attempts."""
    number = 3 + F.when(attempt > _LONGER, attempt - _LONGER).otherwise(0)

    def spelled(script: str) -> Column:
        options = F.array(*[F.lit(s) for s in _SYLLABLES[script]])
        return F.array_join(
            F.transform(
                F.sequence(F.lit(1), number),
                lambda i: F.element_at(options, _byte(digest, i) % len(_SYLLABLES[script]) + 1),
            ),
            "",
        )

    cyrillic = F.regexp_like(real, F.lit(r"^\p{IsCyrillic}"))
    return F.when(cyrillic, spelled("cyrillic")).otherwise(spelled("latin"))


def stand_in(kind: Column, real: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a part in its canonical form, as names are before their endings."""

    def draw(digest: Column) -> Column:
        local = F.substring_index(real, "@", 1)
        tail = F.when(attempt > _LONGER, attempt.cast("string")).otherwise("")
        host = F.regexp_replace(F.substring_index(real, "@", -1), r"\.[^.]*$", "")
        # The host's own digest keeps addresses of one host together; .example is reserved.
        host = _scrambled(host, F.sha2(F.concat(F.lit(f"{key}|host|"), host), 512))
        octets = F.transform(
            F.sequence(F.lit(1), F.lit(4)),
            lambda i: F.when(i == 1, 240 + _byte(digest, i) % 15).otherwise(_byte(digest, i)),
        )
        return (
            F.when(
                kind == "email",
                F.concat(_scrambled(local, digest), tail, F.lit("@"), host, F.lit(".example")),
            )
            .when(
                kind == "ip",
                F.concat(
                    F.array_join(octets.cast("array<string>"), "."),
                    F.when(tail != "", F.concat(F.lit("."), tail)).otherwise(""),
                ),
            )
            .when(kind == "card", _card(real, digest, tail))
            .when(
                kind == "ssn",
                F.concat(F.lit("9"), F.substr(_scrambled(real, digest), F.lit(2)), tail),
            )
            .when(
                kind == "phone",
                # Area codes start with 2 to 9.
                F.concat(
                    (2 + _byte(digest, F.lit(64)) % 8).cast("string"),
                    F.substr(_scrambled(real, digest), F.lit(2)),
                    tail,
                ),
            )
            .when(kind == "key", F.concat(_scrambled(real, digest, 4), tail))
            .when(kind == "iban", F.concat(_scrambled(real, digest, 2), tail))
            .when(kind == "secret", F.concat(_scrambled(real, digest), tail))
            .otherwise(_syllables(real, digest, attempt))
        )

    seed = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), real)
    return _let(F.sha2(seed, 512), draw)


def _filled(entity: Column, chars: Column) -> Column:
    """The entity with its letters and digits replaced in turn, from the right end; what the
    entity has no room for goes before its first."""

    def of(extra: Column) -> Column:
        def swap(i: Column) -> Column:
            char = F.substr(entity, i, F.lit(1))
            place = F.length(F.regexp_replace(F.left(entity, i), "[^0-9A-Za-z]", "")) - extra
            open_ = F.regexp_like(char, F.lit("[0-9A-Za-z]")) & (place > 0)
            return F.when(open_, F.substr(chars, place, F.lit(1))).otherwise(char)

        written = F.array_join(F.transform(F.sequence(F.lit(1), F.length(entity)), swap), "")
        before = F.regexp_extract(entity, "^([^0-9A-Za-z]*)", 1)
        longer = F.concat(
            before, F.left(chars, -extra), F.substr(written, F.length(before) + F.lit(1))
        )
        return F.when(extra < 0, longer).otherwise(written)

    own = F.length(F.regexp_replace(entity, "[^0-9A-Za-z]", ""))
    return _let(own - F.length(chars), of)


def _written(entity: Column, found: Column, attempts: Column, key: str) -> Column:
    """An entity's surrogate in the entity's own format."""

    def new(part: Column) -> Column:
        known = F.coalesce(
            F.element_at(attempts, F.concat_ws("|", part["kind"], part["real"])), F.lit(0)
        )
        return stand_in(part["kind"], part["real"], known, key)

    def name(group: int, told: str, stem: Column) -> Column:
        shown = F.regexp_extract(entity, _PERSON, group)
        gender = _gender(F.regexp_extract(entity, _PERSON, 1))
        cyrillic = F.regexp_like(shown, F.lit(r"^\p{IsCyrillic}"))
        ending = F.lit("")
        for letter in "mfe":
            by = _ENDINGS[f"{told}_{letter}"]
            ending = F.when(
                gender == letter,
                F.when(cyrillic, by["cyrillic"]).otherwise(by["latin"]),
            ).otherwise(ending)
        whole = F.initcap(F.concat(stem, ending))
        return F.when((F.upper(shown) == shown), F.upper(whole)).otherwise(whole)

    def of(kind: Column, first: Column, second: Column) -> Column:
        title = F.regexp_extract(entity, _PERSON, 1)
        gap = F.regexp_extract(entity, _PERSON, 3)
        shouted = (F.upper(entity) == entity) & (F.lower(entity) != entity)
        return (
            F.when(
                kind == "email",
                F.when(shouted, F.upper(first)).otherwise(first),
            )
            .when(kind == "secret", F.concat(F.regexp_extract(entity, _VALUE, 1), first))
            .when(kind.isin("ip", "key"), first)
            .when(kind == "surname", F.concat(title, name(2, "surname", first)))
            .when(
                kind.startswith("given"),
                F.concat(
                    title,
                    name(2, "given", first),
                    gap,
                    name(4, "surname", second),
                ),
            )
            .otherwise(_filled(entity, first))
        )

    kind = F.element_at(found, 1)["kind"]
    # Read with get(), which is null past the end: most entities have one part.
    return _let(F.transform(found, new), lambda x: of(kind, F.get(x, F.lit(0)), F.get(x, F.lit(1))))


def entities(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), 0)


def _attempts(seen: DataFrame, key: str) -> DataFrame:
    """(kind, real, attempt) of the parts that collide at attempt 0."""
    real = seen.select("kind", "real")
    state = cut_lineage(real.withColumn("attempt", F.lit(0)))
    while True:
        drawn = state.withColumn("new", stand_in(F.col("kind"), F.col("real"), F.col("attempt"), key))
        first = drawn.groupBy("kind", "new").agg(
            F.min(F.struct("attempt", "real")).alias("holder"), F.count("*").alias("n")
        )
        taken = real.select("kind", F.col("real").alias("new"), F.lit(True).alias("is_real"))
        clash = first.join(taken, ["kind", "new"], "left").where("n > 1 or is_real")
        # Names are compared before their endings, so they cannot equal real ones.
        moved = drawn.join(clash, ["kind", "new"]).where(
            "is_real or holder.real != real"
        ).select("kind", "real", (F.col("attempt") + 1).alias("attempt"))
        moved = cut_lineage(moved)
        if moved.isEmpty():
            break
        state = cut_lineage(
            state.join(moved.select("kind", "real"), ["kind", "real"], "left_anti").unionByName(moved)
        )
    return state.where("attempt > 0")


def replace(
    docs: DataFrame,
    key: str,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced and their number as ``n_entities``.

    Null texts stay null, empty ones empty, both with 0 entities; texts without entities are
    unchanged. Rows are replaced alike wherever they stand, so repeated rows stay equal.
    Every row and column stays; a column named ``n_entities`` is replaced.
    """
    docs = docs.drop("n_entities")
    row = F.xxhash64(doc_id, text)
    own, tried = unused("row", docs.columns), unused("attempts", docs.columns)
    held = F.regexp_like(F.col(text), F.lit(ANY))
    found = F.flatten(F.transform(entities(F.col(text)), parts))
    mentioned = cut_lineage(
        docs.where(held).select(row.alias(own), F.inline(F.array_distinct(found)))
    )
    later = _attempts(mentioned.select("kind", "real").distinct(), key)
    # Stored, so that its size is known before the join: short tables are broadcast, and
    # only a long one makes the texts move.
    by_row = cut_lineage(
        mentioned.join(later, ["kind", "real"])
        .groupBy(own)
        .agg(
            F.map_from_entries(
                F.collect_set(F.struct(F.concat_ws("|", "kind", "real"), "attempt"))
            ).alias(tried)
        )
    )
    joined = docs.withColumn(own, row).join(by_row, own, "left")
    between = F.split(F.col(text), ANY, -1)
    new = F.transform(
        entities(F.col(text)),
        lambda e: _let(parts(e), lambda p: _written(e, p, F.col(tried), key)),
    )
    rewritten = F.array_join(
        F.zip_with(between, new, lambda before, x: F.concat(before, F.coalesce(x, F.lit("")))), ""
    )
    return joined.select(
        *[
            (F.when(held, rewritten).otherwise(F.col(text)).alias(text) if c == text else F.col(c))
            for c in docs.columns
        ],
        F.when(held, F.size(entities(F.col(text)))).otherwise(0).alias("n_entities"),
    )
