"""Personal data and secrets replaced by keyed surrogates, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.columns import shielded
from tessera.plans.prefix import cut_lineage, join_on_keys

# What entities look like. Secrets and names are found by what stands before them.
_TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Señora?|Sra?|Monsieur|Madame|Mme|Signora?|Г-н|Г-жа|Κύριος|Κυρία"
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "key": r"\bAKIA[0-9A-Z]{16}\b",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "phone": r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){1,3}(?!\d)",
    "card": r"(?<!\d)(?:\d{4}[ -]?){3}\d{4}(?!\d)",
    "id": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "name": rf"(?<=(?<!\p{{L}})(?:{_TITLES})\.? )\p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?",
    "secret": r"(?<=(?i:password|passwd|token|secret|api_key)\s{0,2}[=:]\s{0,2}[\"']?)[A-Za-z0-9+/_-]{8,}",
}
# Types are told apart by the match alone, in this order; what fits none is a secret.
_KINDS = {k: PATTERNS[k] for k in ("email", "key", "ip", "phone", "card", "id")} | {"name": r"\p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+)?"}
_ANY = "|".join(PATTERNS.values())
#: What a text with an entity holds in any case; cheaper to look for than the entities.
_HINT = rf"[@+]|\d{{3}}|\d\.\d|AKIA|(?i:password|passwd|token|secret|api_key)|(?:{_TITLES})\.? "
# Letters that stand for each other; a character of none of the rows stays.
_SWAPS = (
    "0123456789",
    "bcdfghjklmnpqrstvwxz", "aeiouy", "BCDFGHJKLMNPQRSTVWXZ", "AEIOUY",
    "áàâäéèêëíîïóòôöúùûü", "ÁÀÂÄÉÈÊËÍÎÏÓÒÔÖÚÙÛÜ",
    "бвгджзклмнпрстфхцчш", "аеиоуыэюя", "БВГДЖЗКЛМНПРСТФХЦЧШ", "АЕИОУЭЮЯ",
    "βγδζθκλμνξπρστφχψ", "αεηιουω", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ", "ΑΕΗΙΟΥΩ",
    "山川田中村林森木石水上下大小高北南東西原",
)
_HEX = ("0123456789", "abcdef")
#: Attempts after which a surrogate of a short entity gets longer, so that distinct ones never run out.
PATIENCE = 8


def _kind(match: Column) -> Column:
    kind = F.lit("secret")
    for name, pattern in reversed(_KINDS.items()):
        kind = F.when(match.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def _canon(kind: Column, match: Column) -> Column:
    """What all ways to write an entity have in common."""
    digits = F.regexp_replace(match, r"\D", "")
    return F.when(kind.isin("phone", "card", "id"), digits).when(kind.isin("email", "name"), F.lower(match)).otherwise(match)


def _draw(digest: Column, at: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(digest, at), F.lit(n))


def _swapped(char: Column, digest: Column, at: Column, rows: tuple[str, ...]) -> Column:
    """Another character of the same row, by the digest and the place."""
    out = char
    for row in rows:
        out = F.when(F.instr(F.lit(row), char) > 0, F.substring(F.lit(row), _draw(digest, at, len(row)).cast("int") + 1, 1)).otherwise(out)
    return out


def _by_character(text: Column, digest: Column, rows: tuple[str, ...] = _SWAPS, kept: Column | None = None, names: bool = False) -> Column:
    """``text`` with letters and digits swapped; the first ``kept`` characters stay, in names the last two of each word.

    Draws go by the place among letters and digits, so that separators make no difference.
    """

    def one(i: Column) -> Column:
        char = F.substring(text, i, 1)
        at = F.length(F.regexp_replace(F.substring(text, 1, i), r"[^\p{L}\p{N}]", ""))
        swapped = _swapped(char, digest, at, rows)
        if names:
            ending = F.substring(text, i + 1, F.lit(2)).rlike(r"^\p{L}?(?:[^\p{L}]|$)")
            return F.when(ending, char).otherwise(swapped)
        return swapped if kept is None else F.when(i <= kept, char).otherwise(swapped)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")


def _card(match: Column, digest: Column) -> Column:
    """The first digit and the separators stay; the last digit is the check digit that cards have."""
    first = F.substring(F.regexp_replace(match, r"\D", ""), 1, 1).cast("int")
    digit = lambda k: F.when(k == 1, first).otherwise(_draw(digest, k, 10).cast("int"))
    weighed = F.transform(F.sequence(F.lit(1), F.lit(15)), lambda k: F.when(k % 2 == 1, digit(k) * 2 - F.when(digit(k) > 4, 9).otherwise(0)).otherwise(digit(k)))
    total = F.aggregate(weighed, F.lit(0), lambda s, x: s + x)

    def one(i: Column) -> Column:
        char = F.substring(match, i, 1)
        at = F.length(F.regexp_replace(F.substring(match, 1, i), r"\D", ""))
        value = F.when(at == 16, (10 - total % 10) % 10).otherwise(digit(at))
        return F.when(char.rlike(r"\d"), value.cast("string")).otherwise(char)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(match)), one), "")


def _surrogate(kind: Column, match: Column, attempt: Column, key: str) -> Column:
    """What stands for ``match``: a keyed function of what the entity is, in the form of the match."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, _canon(kind, match), attempt.cast("string")), 256)
    more = F.when(attempt >= PATIENCE, F.concat(F.lit("x"), F.substring(digest, 1, 12))).otherwise("")
    labels = F.split(F.substring_index(match, "@", -1), r"\.")
    above = F.array_join(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), ".")
    # mail goes to a reserved domain
    email = F.concat(
        _by_character(F.substring_index(match, "@", 1), digest), more, F.lit("@"),
        F.when(above != "", F.concat(_by_character(above, digest), F.lit("."))).otherwise(""), F.lit("example.com"),
    )
    octets = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_draw(digest, i, 223) + 1).cast("string")), ".")
    country = F.length(F.regexp_extract(match, r"^\+\d{1,3}(?=\D)|^\+\d", 0))
    hexadecimal = F.concat(_by_character(match, digest, _HEX), F.when(attempt >= PATIENCE, F.substring(digest, 1, 12)).otherwise(""))
    return (
        F.when(kind == "email", email)
        .when(kind == "key", _by_character(match, digest, kept=F.lit(4)))
        .when(kind == "ip", octets)
        .when(kind == "phone", _by_character(match, digest, kept=country))
        .when(kind == "card", _card(match, digest))
        .when(kind == "id", _by_character(match, digest))
        .when(kind == "name", F.concat(_by_character(match, digest, names=True), more))
        .when(match.rlike("^[0-9a-f]+$"), hexadecimal)
        .otherwise(F.concat(_by_character(match, digest), more))
    )


def _entities(docs: DataFrame) -> DataFrame:
    """(kind, canon) of every entity, once."""
    found = docs.where(F.col("text").rlike(_HINT)).select(F.explode(F.regexp_extract_all("text", F.lit(_ANY), F.lit(0))).alias("match"))
    typed = found.groupBy("match").count().withColumn("kind", _kind(F.col("match")))
    return typed.select("kind", _canon(F.col("kind"), F.col("match")).alias("canon")).distinct()


def attempts(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt) of the entities whose first surrogate is taken: the attempt that gives each its own.

    A surrogate is taken if it is one of the entities themselves or if another entity has it;
    of those the one with fewer attempts keeps it, then the lesser. Rounds go on until no two
    entities share a surrogate.
    """
    real = entities.select("kind", F.col("canon").alias("sur"), F.lit(True).alias("is_real"))
    named = entities.withColumn("attempt", F.lit(0))
    while True:
        sur = _canon(F.col("kind"), _surrogate(F.col("kind"), F.col("canon_as_written"), F.col("attempt"), key))
        tried = cut_lineage(named.withColumn("canon_as_written", _written(F.col("kind"), F.col("canon"))).withColumn("sur", sur).drop("canon_as_written"))
        owners = tried.groupBy("kind", "sur").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "canon")).alias("owner"))
        checked = owners.join(real, ["kind", "sur"], "left")
        clash = checked.where("n > 1 or is_real").select("kind", "sur", F.col("owner.canon").alias("owner"), F.coalesce("is_real", F.lit(False)).alias("is_real"))
        joined = tried.join(clash, ["kind", "sur"], "left")
        loses = F.col("owner").isNotNull() & (F.col("is_real") | (F.col("canon") != F.col("owner")))
        named = cut_lineage(joined.withColumn("loses", loses).select("kind", "canon", (F.col("attempt") + F.col("loses").cast("int")).alias("attempt"), "loses"))
        lost = named.where("loses").limit(1).count()
        named = named.drop("loses")
        if not lost:
            return named.where("attempt > 0")


def _written(kind: Column, canon: Column) -> Column:
    """A way to write an entity again that its canonical form is of the kind."""
    return F.when(kind == "phone", F.concat(F.lit("+"), canon)).otherwise(canon)


def replace(docs: DataFrame, key: str) -> DataFrame:
    """All columns of ``docs`` with the entities in ``text`` replaced, and n_entities, the number replaced.

    E-mail addresses, phone, card and identity numbers, IP addresses, access keys, secrets
    after ``password=`` and the like, and names after a title are found by pattern. Each gets
    a surrogate of its type and form: digits for digits, vowels for vowels and consonants for
    consonants of the same script and case, separators in place. Phone numbers keep the
    country code, cards the first digit and a valid check digit, names their endings (which
    show gender, as the title does), mail goes to example.com. The surrogate is a function of
    ``key`` and the entity however written (case of mail and names, separators of numbers), so
    that an entity has one surrogate in all texts; distinct entities of a type have distinct
    surrogates, none of which is an entity of the table itself.

    A null text stays null and has no entities, an empty one stays empty. Repeated rows stay
    repeated, equal texts give equal texts. An empty table gives no rows. A column
    n_entities is replaced, other columns pass through.
    """
    docs, restore = shielded(docs, ["text"])
    again = cut_lineage(attempts(cut_lineage(_entities(docs)), key))
    matches = F.regexp_extract_all("text", F.lit(_ANY), F.lit(0))
    has = F.col("text").rlike(_HINT)
    rows = docs.withColumn("_match", F.when(F.coalesce(has, F.lit(False)), matches).otherwise(F.array().cast("array<string>")))
    changed = again.limit(1).count() > 0
    if changed:
        # the few entities that need another attempt, by the text that holds them
        typed = docs.where(has).select("text").distinct().select(F.xxhash64("text").alias("_of"), F.posexplode(matches).alias("at", "match"))
        typed = typed.withColumn("kind", _kind(F.col("match"))).withColumn("canon", _canon(F.col("kind"), F.col("match")))
        retried = typed.join(again, ["kind", "canon"]).groupBy("_of").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("at", "attempt")))).alias("_again"))
        rows = join_on_keys(rows.withColumn("_of", F.xxhash64("text")), retried, ["_of"], "left").drop("_of")
    else:
        rows = rows.withColumn("_again", F.lit(None).cast("map<int,int>"))

    def one(match: Column, i: Column) -> Column:
        return _surrogate(_kind(match), match, F.coalesce(F.try_element_at("_again", i), F.lit(0)), key)

    gaps = F.split("text", _ANY, -1)
    after = F.transform(F.slice(gaps, F.lit(2), F.size("_match")), lambda gap, i: F.concat(F.get("_new", i), gap))
    new = F.transform("_match", one)
    rebuilt = F.concat(F.get(gaps, F.lit(0)), F.array_join(after, ""))
    rows = rows.withColumn("_new", new)
    out = rows.withColumn("text", F.when(F.size("_match") > 0, rebuilt).otherwise(F.col("text"))).withColumn("n_entities", F.size("_match").cast("bigint"))
    return restore(out, ["n_entities"])
