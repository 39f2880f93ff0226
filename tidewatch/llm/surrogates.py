"""Keyed surrogates for personal data, in DataFrame functions only.

E-mail addresses, phone numbers, IPv4 addresses, payment cards, IBANs, US social security numbers, secrets after words such as
``password=`` in any case, whatever their length, and names after a title are found by patterns, and each is replaced by one of its own type: same length (but for e-mail and IP addresses, and
names whose first surrogate clashes) and signs, digit for digit, letter for letter of the same case and script, hexadecimal staying hexadecimal, a card number with a valid
check digit, a first name of the gender the title tells. A replacement depends on the secret key, the type and the entity
without its formatting, so one entity has one surrogate everywhere, however it is written.

Different entities get different surrogates: the distinct entities of all documents are counted, those whose surrogate clashes with
another's or with a real entity get another turn, all but one, until none clashes. Turns above the first are few; they are
joined to the documents that need them. Texts are not shuffled for entities with the first turn.

Null text stays null with 0 entities, empty text stays empty. A null id keeps its row, repeated rows are treated alike; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import ready, table
from tidewatch.session import materialise

# fixed values: titles that tell a gender, and names to give
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme"]
MALE_TITLES = ["Mr", "Herr", "Señor", "Monsieur"]
OTHER_TITLES = ["Dr", "Prof"]
FEMALE = ["Anna", "Clara", "Diana", "Elena", "Flora", "Greta", "Helen", "Irene", "Julia", "Karen", "Laura", "Maria", "Nadia", "Olga", "Petra", "Rosa"]
MALE = ["Adam", "Bruno", "Carl", "David", "Erik", "Felix", "Georg", "Henry", "Ivan", "Jonas", "Kevin", "Lukas", "Martin", "Niels", "Oscar", "Peter"]
EITHER = ["Alex", "Chris", "Dana", "Jamie", "Kim", "Lee", "Morgan", "Robin", "Sam", "Taylor"]
# fixed values: letters that stand in for letters of a script
SCRIPTS = [
    ("[a-z]", "abcdefghijklmnopqrstuvwxyz"),
    ("[à-öø-ÿ]", "àáâãäåæçèéêëìíîïñòóôõöøùúûüý"),
    ("[а-яё]", "абвгдежзийклмнопрстуфхцчшщъыьэюя"),
    ("[α-ω]", "αβγδεζηθικλμνξοπρστυφχψω"),
]

_TITLE = rf"\b(?:{'|'.join(FEMALE_TITLES + MALE_TITLES + OTHER_TITLES)})\.? "
_SECRET = r"(?i:password|passwd|pwd|secret|token|api_key|apikey|api-key)[ ]{0,2}[=:][ ]{0,2}[\"']?"
_WORD = r"A-Za-z0-9\u00C0-\u024F\u0370-\u03FF\u0400-\u04FF"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# What begins a match is cheap to refuse at any other place, so a text costs about one step for each character and pattern.
PATTERNS = {
    # a dot is part of a secret where more of it follows
    "secret": _SECRET + r"[A-Za-z0-9_/+=~.-]{7,}[A-Za-z0-9_/+=~-]",
    "name": _TITLE + r"\p{Lu}\p{L}{1,30}(?: \p{Lu}\p{L}{1,30})?",
    "email": rf"(?<![{_WORD}._%+-])[{_WORD}._%+-]{{1,64}}+@[{_WORD}-]{{1,63}}(?:\.[{_WORD}-]{{1,63}}){{1,6}}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])",
}
_NUMBERS = ("ip", "card", "ssn", "phone")
ANY = "|".join(f"(?:{PATTERNS[k]})" for k in PATTERNS if k not in _NUMBERS) + "|(?=[0-9+(])(?:" + "|".join(PATTERNS[k] for k in _NUMBERS) + ")"
# every pattern needs one of these
MAYBE = rf"[0-9@]|{_SECRET}|{_TITLE}"
MOST_TURNS = 50


def kind_of(entity: Column) -> Column:
    """The first type whose pattern, looked at alone, fits the whole entity."""
    out = F.lit("secret")
    for name in ("phone", "ssn", "card", "ip", "iban", "email", "name", "secret"):
        out = F.when(entity.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(out)
    return out


def lead_of(kind: Column, entity: Column) -> Column:
    """The words that tell the type and stay: a title, or what names a secret."""
    return F.when(kind == "name", F.regexp_extract(entity, "^" + _TITLE, 0)).when(kind == "secret", F.regexp_extract(entity, "^" + _SECRET, 0)).otherwise("")


def gender_of(title: Column) -> Column:
    """What a title says: f, m or x."""
    said = lambda titles: title.rlike(rf"^(?:{'|'.join(titles)})\.? $")
    return F.when(said(FEMALE_TITLES), "f").when(said(MALE_TITLES), "m").otherwise("x")


def bare(kind: Column, entity: Column) -> Column:
    """The entity without its formatting."""
    return F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(entity, "[^0-9]", "")).when(
        kind == "iban", F.regexp_replace(entity, " ", "")
    ).when(kind == "secret", entity).otherwise(F.lower(entity))


def pick(seed: Column, place: Column, n) -> Column:
    return F.pmod(F.xxhash64(seed, place), n if isinstance(n, Column) else F.lit(n)).cast("int")


def scrambled(value: Column, seed: Column) -> Column:
    """Another value of the same form: each digit and letter by the seed and its place; all else stays."""
    hexadecimal = value.rlike("^([0-9a-f]*|[0-9A-F]*)$") & value.rlike("[A-Fa-f]") & value.rlike("[0-9]")

    def one(c, i):
        out = c
        for pattern, letters in reversed(SCRIPTS):
            low = F.substring(F.lit(letters), pick(seed, i, len(letters)) + 1, F.lit(1))
            out = F.when(F.lower(c).rlike(pattern), F.when(c == F.lower(c), low).otherwise(F.upper(low))).otherwise(out)
        out = F.when(c.rlike("[0-9]"), pick(seed, i, 10).cast("string")).otherwise(out)
        digit = F.substring(F.lit("0123456789abcdef"), pick(seed, i, 16) + 1, F.lit(1))
        return F.when(hexadecimal, F.when(value.rlike("[A-F]"), F.upper(digit)).otherwise(digit)).otherwise(out)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def with_check_digit(digits: Column) -> Column:
    """The digits with the last one set so that the number passes the Luhn test."""
    body = F.reverse(F.substring(digits, F.lit(1), F.length(digits) - 1))
    twice = lambda c, i: F.when(i % 2 == 0, F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))
    total = F.aggregate(F.transform(F.split(body, ""), twice), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string"))


def surrogate(kind: Column, gender: Column, value: Column, turn: Column, key: str) -> Column:
    """The bare surrogate of a bare entity."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, value, turn.cast("string")), 256)
    named = lambda names: F.get(F.array(*[F.lit(x.lower()) for x in names]), pick(seed, F.lit(1), len(names)))
    first = F.when(gender == "f", named(FEMALE)).when(gender == "m", named(MALE)).otherwise(named(EITHER))
    given = F.when(value.rlike("^[\\x00-\\x7F]*$"), first).otherwise(scrambled(F.split(value, " ")[0], seed))
    last = F.element_at(F.split(value, " "), -1)
    # a name that clashed gets a letter more each turn, so that there is room for any number of short names
    family = scrambled(F.concat(last, F.repeat(F.right(last, F.lit(1)), turn)), F.concat(seed, F.lit("f")))
    name = F.when(value.contains(" "), F.concat(given, F.lit(" "), family)).otherwise(family)
    domain = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.element_at(F.split(value, "@"), -1)), 256)
    email = F.concat(scrambled(F.split(value, "@")[0], seed), F.lit("@site"), F.substring(domain, 1, 8), F.lit(".example"))
    # a private block first, then the blocks kept for later use
    block = F.when(turn == 0, F.lit(10)).otherwise(240 + pick(seed, F.lit(3), 15))
    ip = F.concat_ws(".", block.cast("string"), *[pick(seed, F.lit(i), 256).cast("string") for i in range(3)])
    digits = scrambled(value, seed)
    # the country code of a phone number stays
    return F.when(kind == "name", name).when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", with_check_digit(digits)).when(
        kind == "iban", F.concat(F.substring(value, 1, 2), F.substring(digits, F.lit(3), F.length(value)))
    ).otherwise(digits)


def formatted(kind: Column, entity: Column, new: Column) -> Column:
    """The surrogate in the entity's formatting: its signs, and its capitals for names."""
    letters = F.split(new, "")
    walk = F.aggregate(
        F.split(entity, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("k")),
        lambda s, c: F.when(c.rlike("[0-9A-Za-z]"), F.struct(F.concat(s["out"], F.coalesce(F.get(letters, s["k"]), F.lit(""))).alias("out"), (s["k"] + 1).alias("k"))).otherwise(
            F.struct(F.concat(s["out"], c).alias("out"), s["k"].alias("k"))),
        lambda s: s["out"],
    )
    return F.when(kind.isin("phone", "card", "ssn", "iban"), walk).when(kind == "name", F.initcap(new)).otherwise(new)


def found(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``crc``, ``text``, ``rest`` (the text between entities) and ``e`` (entity, kind, gender, lead and bare value of each)."""
    body = F.col("text").cast("string")
    maybe = body.rlike(MAYBE)
    rows = docs.select(
        "doc_id", F.md5(body.cast("binary")).alias("crc"), body.alias("text"),
        F.when(maybe, F.regexp_extract_all(body, F.lit(ANY), F.lit(0))).otherwise(F.array()).alias("hits"),
    )
    rows = rows.withColumn("rest", F.when(F.size("hits") > 0, F.split("text", ANY, -1)).otherwise(F.array()))
    rows = rows.withColumn("e", F.transform("hits", lambda x: F.struct(x.alias("entity"), kind_of(x).alias("kind"))))
    rows = rows.withColumn("e", F.transform("e", lambda x: F.struct(x["entity"].alias("entity"), x["kind"].alias("kind"), lead_of(x["kind"], x["entity"]).alias("lead"))))
    rows = rows.withColumn("e", F.transform("e", lambda x: F.struct(F.substring(x["entity"], F.length(x["lead"]) + 1, F.length(x["entity"])).alias("entity"), x["kind"].alias("kind"), gender_of(x["lead"]).alias("gender"), x["lead"].alias("lead"))))
    return rows.withColumn("e", F.transform("e", lambda x: F.struct(x["entity"].alias("entity"), x["kind"].alias("kind"), x["gender"].alias("gender"), x["lead"].alias("lead"), bare(x["kind"], x["entity"]).alias("value")))).drop("hits")


def turns(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``gender``, ``value``, ``turn`` of the entities whose first surrogate clashes with another's or a real entity."""
    real = entities.select(F.col("kind").alias("rk"), F.col("value").alias("rv")).distinct()
    now = entities.select("kind", "gender", "value", F.lit(0).alias("turn"))
    for _ in range(MOST_TURNS):
        made = materialise(now.withColumn("new", surrogate(F.col("kind"), F.col("gender"), F.col("value"), F.col("turn"), key)), "surrogates")
        first = made.groupBy("kind", "new").agg(F.min(F.struct("turn", "value", "gender")).alias("holder"), F.count("*").alias("n")).where("n > 1")
        clash = made.join(first, ["kind", "new"]).where("struct(turn, value, gender) != holder").select("kind", "gender", "value")
        taken = made.join(real, (F.col("kind") == F.col("rk")) & (F.col("new") == F.col("rv")), "left_semi").select("kind", "gender", "value")
        again = materialise(clash.unionByName(taken).distinct(), "clashes")
        if again.isEmpty():
            return made.where("turn > 0").select("kind", "gender", "value", "turn")
        now = made.drop("new").join(again.withColumn("more", F.lit(1)), ["kind", "gender", "value"], "left").select("kind", "gender", "value", (F.col("turn") + F.coalesce("more", F.lit(0))).alias("turn"))
    raise ValueError(f"surrogates still clash after {MOST_TURNS} turns")


def replace(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id``, ``n_entities`` and ``text`` with every entity replaced."""
    ready(docs.sparkSession)
    rows = found(docs)
    listed = materialise(rows.where(F.size("e") > 0).select("doc_id", "crc", "e"), "entities")
    each = listed.select("doc_id", "crc", F.explode("e").alias("e")).select("doc_id", "crc", "e.kind", "e.gender", "e.value")
    later = materialise(turns(each.select("kind", "gender", "value").distinct(), key), "later-turns")
    of_doc = each.join(later, ["kind", "gender", "value"]).groupBy("doc_id", "crc").agg(F.collect_set(F.struct("kind", "gender", "value", "turn")).alias("later"))
    of_doc = materialise(of_doc.select(F.col("doc_id").alias("_id"), F.col("crc").alias("_crc"), "later"), "later-by-document")

    rows = rows.join(of_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("crc").eqNullSafe(F.col("_crc")), "left")

    def new(x):
        mine = F.filter("later", lambda t: (t["kind"] == x["kind"]) & (t["gender"] == x["gender"]) & (t["value"] == x["value"]))
        turn = F.coalesce(F.get(mine, F.lit(0))["turn"], F.lit(0))
        return F.concat(x["lead"], formatted(x["kind"], x["entity"], surrogate(x["kind"], x["gender"], x["value"], turn, key)))

    pieces = F.zip_with("rest", F.transform("e", new), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    text = F.when(F.size("e") > 0, F.array_join(pieces, "")).otherwise(F.col("text"))
    return rows.select("doc_id", F.greatest(F.coalesce(F.size("e"), F.lit(0)), F.lit(0)).alias("n_entities"), text.alias("text"))


def op7_surrogates(spark, sf_dir: str, key: str = "a key that production sets itself") -> DataFrame:
    return replace(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
