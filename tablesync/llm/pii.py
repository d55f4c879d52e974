"""Surrogates for personal data: keyed, of the entity's type and format. DataFrame functions only.

One pattern finds e-mail addresses, phone, card, account and social security numbers, IPv4
addresses, access keys, assigned secrets and titled person names. Each distinct entity (canonical: letter case,
blanks and separators aside) gets one surrogate in the whole table, drawn from a keyed
hash: digits become digits, letters become letters of the same script and case, names become names of the same
gender and script; country codes, issuer digits, Luhn validity, e-mail domains shared by
addresses, separators and quotes stay as they were. Collision checks draw anew for an entity whose surrogate another
entity has or that is itself a real entity of the table, until all are distinct.

Defined results: a null text stays null, an empty one empty; a text without entities is unchanged;
repeated rows get equal results; null ids are kept; an empty table gives no rows. Names are found
after a title, which also tells the gender ("" where the title does not). Within a document a titled name that is part of a
longer one ("Mr. Smith", "Dr. J. Smith" beside "Mr. John Smith") is the same person, and capitalised words that are a part
of a found name are replaced without a title too, each part by its own part of the surrogate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

# Titles before names, and surrogate names by gender and script.
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Госпожа"],
    "": ["Dr", "Prof"],
}
NAMES = {
    "latin": {
        "m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Lucas", "Marco", "Nico", "Oscar", "Paul"],
        "f": ["Alma", "Berta", "Clara", "Dora", "Elena", "Flora", "Greta", "Helena", "Irma", "Julia", "Karla", "Laura", "Maria", "Nora", "Olga", "Paula"],
        "": ["Alex", "Billie", "Charlie", "Dana", "Eden", "Frankie", "Jamie", "Kim", "Lou", "Max", "Noel", "Pat", "Robin", "Sam", "Toni", "Val"],
        "last": ["Abel", "Bauer", "Costa", "Duval", "Engel", "Ferrer", "Garnier", "Holm", "Ibarra", "Jansen", "Keller", "Lund", "Moreau", "Novak", "Ortiz", "Petit", "Quint", "Rossi", "Soler", "Thorn", "Urban", "Vidal", "Weber", "Zorn"],
    },
    "cyrillic": {
        "m": ["Алексей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Игорь"],
        "f": ["Анна", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Ирина", "Лидия"],
        "": ["Женя", "Саша", "Валя", "Слава"],
        "last": ["Бондарь", "Гончар", "Дяченко", "Коваль", "Литвин", "Мельник", "Носенко", "Петренко"],
    },
}
SECRET_WORDS = ["password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key"]

_SECRET = r"(?i:(?<![\p{L}\p{N}])(?:" + "|".join(SECRET_WORDS) + r")\s{0,3}[=:]\s{0,3}[\"']?[^\s\"']{6,}[\"']?)"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_TITLE = "(?:" + "|".join(t for titles in TITLES.values() for t in [*titles, *map(str.upper, titles)]) + r")(?!\p{L})"
_CAPITAL = r"\p{Lu}[\p{L}'’-]+"
_INITIAL = r"(?:\p{Lu}\.)+|\p{Lu}"
_ENDING = r"(?:['’][sS]?|-)$"  # of a name: a possessive
_TOKEN = r"(?<!\p{L})" + _CAPITAL

#: Kind and pattern; where two could match at one place, the first counts.
KINDS = {
    "secret": _SECRET,
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])\d(?:[ -]?\d){12,18}(?![A-Za-z0-9])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|\+\d{1,3}[ .-]\d{1,2}(?:[ .-]\d{2}){4}(?!\d)|(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\p{L}\p{N}-])"
    r"|0[1-9](?:[ .-]\d{2}){4}(?![\p{L}\p{N}-])|(?:\(0\d{1,4}\)|0\d{2,4})[ /-]{1,3}\d{3,4}[ -]?\d{2,5}(?![\p{L}\p{N}-])"
    r"|(?<!\d[ .,])(?:[6-9]\d{2}(?:[ -]\d{3}){2}|[6-9]\d{2}(?:[ -]\d{2}){3}|[89]\d[ -]\d{3}(?:[ -]\d{2}){2})(?![\p{L}\p{N}-]|[ .,]\d))",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "ip": r"(?<![\p{L}\p{N}.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![\p{L}\p{N}]|\.\d)",
    "name": r"(?<!\p{L})" + _TITLE + r"\.?[  ](?:\p{Lu}(?:\.[  ]?|[  ])){0,3}" + _CAPITAL + r"(?:[  ](?:\p{Lu}\.[  ])?" + _CAPITAL + r"){0,2}",
}
PATTERN = "|".join(KINDS.values())


def kind_of(entity: Column) -> Column:
    """The kind whose pattern the whole entity matches."""
    out = F.lit("name")
    for kind, pattern in reversed(list(KINDS.items())):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _shouted(name: Column) -> Column:
    return (name == F.upper(name)) & name.rlike(r"\p{L}{2}")


def parsed(mentions: DataFrame) -> DataFrame:
    """Adds to ``entity``: ``kind``, ``lead`` (kept as it is), ``core`` (replaced), ``tail``, ``canon``, ``gender``."""
    entity, kind = F.col("entity"), F.col("kind")
    secret = r"^((?i:" + "|".join(SECRET_WORDS) + r")\s*[=:]\s*[\"']?)(.*?)([\"']?)$"
    named = "^(" + _TITLE + r"\.?[  ])(.*)$"
    country = r"^(\+\d{1,3}(?:[ .-]|(?=\())|\(?0)(.*)$"  # or the trunk prefix
    lead = F.when(kind == "secret", F.regexp_extract(entity, secret, 1)).when(kind == "name", F.regexp_extract(entity, named, 1))
    lead = lead.when(kind == "phone", F.regexp_extract(entity, country, 1)).otherwise("")
    tail = F.when(kind == "secret", F.regexp_extract(entity, secret, 3)).when(kind == "name", F.regexp_extract(entity, _ENDING, 0)).otherwise("")
    gender = F.lit("")
    for g, titles in TITLES.items():
        if g:
            gender = F.when(F.regexp_extract(entity, "^(" + _TITLE + ")", 1).isin([*titles, *map(str.upper, titles)]), g).otherwise(gender)
    out = mentions.withColumn("kind", kind_of(entity)).withColumn("lead", lead).withColumn("tail", tail)
    core = F.substring(entity, F.length("lead") + 1, F.length(entity) - F.length("lead") - F.length("tail"))
    out = out.withColumn("core", core).withColumn("gender", F.when(kind == "name", gender).otherwise(""))
    core = F.col("core")
    canon = F.when(kind == "email", F.lower(core)).when(kind.isin("phone", "card", "ssn"), F.regexp_replace(core, r"\D", ""))
    canon = canon.when(kind == "iban", F.regexp_replace(core, " ", ""))
    # initials stand apart
    name = F.trim(F.regexp_replace(F.regexp_replace(core, r"\.(?=\p{L})", ". "), r"[  ]+", " "))
    canon = canon.when(kind == "name", F.when(_shouted(core), F.initcap(F.lower(name))).otherwise(name))
    return out.withColumn("canon", canon.otherwise(core))


def _draw(seed: Column, at: Column, n: int) -> Column:
    """A keyed number from 0 to n-1 for a place of the entity."""
    return F.pmod(F.xxhash64(seed, at), F.lit(n))


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number + 1).cast("int"))


def _letters(chars: str, seed: Column, at: Column) -> Column:
    return F.substring(F.lit(chars), (_draw(seed, at, len(chars)) + 1).cast("int"), F.lit(1))


_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CYRILLIC = "абвгдежзиклмнопрстуфхцчшэюя"
_GREEK = "αβγδεζηθικλμνξοπρστυφχψω"
_ACCENTED = "àáâäèéêëìíîïòóôöùúûü"


def _scrambled(text: Column, seed: Column, hexadecimal: Column | None = None) -> Column:
    """Every letter and digit replaced by one of its class; all else stays."""
    hexadecimal = F.lit(False) if hexadecimal is None else hexadecimal

    def one(c: Column, at: Column) -> Column:
        out = F.when(c.rlike("[0-9]"), _draw(seed, at, 10).cast("string"))
        out = out.when(hexadecimal & c.rlike("[a-f]"), _letters("abcdef", seed, at)).when(hexadecimal & c.rlike("[A-F]"), _letters("ABCDEF", seed, at)).when(c.rlike("[a-z]"), _letters(_LOWER, seed, at)).when(c.rlike("[A-Z]"), _letters(_UPPER, seed, at))
        for script, chars in ((r"\p{IsCyrillic}", _CYRILLIC), (r"\p{IsGreek}", _GREEK), (r"\p{IsLatin}", _ACCENTED)):
            out = out.when(c.rlike(script) & c.rlike(r"\p{Lu}"), F.upper(_letters(chars, seed, at))).when(c.rlike(script), _letters(chars, seed, at))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn check over a string of digits (0 modulo 10 if valid)."""

    def value(c: Column, at: Column) -> Column:
        d = c.cast("int") * F.when(at % 2 == 1, 2).otherwise(1)
        return d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, b: a + b)


def _card(canon: Column, seed: Column) -> Column:
    body = F.concat(F.substring(canon, 1, 1), _scrambled(F.substring(canon, F.lit(2), F.length(canon) - 2), seed))
    checked = F.concat(body, F.pmod(-_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))
    return F.when(_luhn_sum(canon) % 10 == 0, checked).otherwise(F.concat(body, _draw(seed, F.lit(99), 10).cast("string")))


def _name(canon: Column, gender: Column, seed: Column, attempt: Column) -> Column:
    def of(script: str) -> Column:
        lists = NAMES[script]
        first = F.when(gender == "m", _pick(lists["m"], _draw(seed, F.lit(1), len(lists["m"]))))
        first = first.when(gender == "f", _pick(lists["f"], _draw(seed, F.lit(1), len(lists["f"])))).otherwise(_pick(lists[""], _draw(seed, F.lit(1), len(lists[""]))))
        last = lambda k: _pick(lists["last"], _draw(seed, F.lit(k), len(lists["last"])))
        parts = F.split(canon, " ")

        def word(part: Column, at: Column) -> Column:
            middle = _pick(lists["last"], _draw(seed, at + 40, len(lists["last"])))
            new = F.when(at == F.size(parts) - 1, last(2)).when(at == 0, first).otherwise(middle)
            return F.when(part.rlike(f"^(?:{_INITIAL})$"), F.concat(F.substring(new, 1, 1), F.lit("."))).otherwise(new)

        full = F.array_join(F.transform(parts, word), " ")
        # the lists are short: later draws join surnames, so there are always more
        more = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), attempt)), lambda k: _pick(lists["last"], _draw(seed, k + 10, len(lists["last"])))), "-")
        return F.when(attempt > 0, F.concat_ws("-", full, more)).otherwise(full)

    return F.when(canon.rlike(r"\p{IsCyrillic}"), of("cyrillic")).otherwise(of("latin"))


def surrogate(key: str, kind: Column, canon: Column, gender: Column, attempt: Column) -> Column:
    """The entity's surrogate, in canonical form, at the given draw."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string")), 256)
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    shared = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain), 256)
    # an address space may be too small for its addresses: later draws lengthen the local part
    longer = F.when(attempt >= 4, F.substring(seed, 1, 8)).otherwise("")
    top = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    email = F.concat(_scrambled(local, seed), longer, F.lit("@"), _scrambled(host, shared), F.lit("."), top)

    def octet(o: Column, at: Column) -> Column:
        low = F.when(F.length(o) == 1, 1 + _draw(seed, at, 9)).when(F.length(o) == 2, 10 + _draw(seed, at, 90))
        return low.otherwise(100 + _draw(seed, at, 155)).cast("string")

    number = F.concat((2 + _draw(seed, F.lit(0), 8)).cast("string"), F.substring(_scrambled(canon, seed), F.lit(2), F.length(canon)))
    access = F.concat(F.substring(canon, 1, 4), F.translate(_scrambled(F.substring(canon, 5, 16), seed), "0189", "2367"))
    account = F.concat(F.substring(canon, 1, 2), _scrambled(F.substring(canon, F.lit(3), F.length(canon)), seed))
    out = F.when(kind == "email", email).when(kind == "ip", F.array_join(F.transform(F.split(canon, r"\."), octet), "."))
    out = out.when(kind.isin("phone", "ssn"), number).when(kind == "card", _card(canon, seed)).when(kind == "key", access)
    out = out.when(kind == "iban", account).when(kind == "name", _name(canon, gender, seed, attempt))
    return out.otherwise(_scrambled(canon, seed, canon.rlike(r"^([0-9a-f]+|[0-9A-F]+)\W*$")))


def rendered(core: Column, kind: Column, new: Column) -> Column:
    """The surrogate in the mention's form: its separators, its letter case."""
    digits = F.regexp_replace(core, r"\d", "#")

    def put(c: Column, at: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(digits, F.lit(1), at), "[^#]", ""))
        return F.when(c == "#", F.substring(new, before + 1, F.lit(1))).otherwise(c)

    spaced = F.array_join(F.transform(F.split(digits, ""), put), "")
    blanks = F.array_join(F.transform(F.split(core, ""), lambda c, at: F.when(c == " ", c).otherwise(F.substring(new, F.length(F.regexp_replace(F.substring(core, F.lit(1), at), " ", "")) + 1, F.lit(1)))), "")
    out = F.when(kind.isin("phone", "card", "ssn"), spaced).when(kind == "iban", blanks)
    return out.when((kind == "email") & (core == F.upper(core)) | (kind == "name") & _shouted(core), F.upper(new)).otherwise(new)


def assign_surrogates(entities: DataFrame, key: str, most: int = 64) -> DataFrame:
    """(kind, canon, sur) for distinct (kind, canon, gender); every ``sur`` of a kind once, none of them a real entity."""
    # a name may stand after titles of different gender: the smallest tag counts, so it has one surrogate
    entities = stash(entities.groupBy("kind", "canon").agg(F.max("gender").alias("gender")), "entities")
    real = entities.select("kind", F.col("canon").alias("sur")).withColumn("is_real", F.lit(True))
    new = lambda: surrogate(key, F.col("kind"), F.col("canon"), F.col("gender"), F.col("attempt"))
    drawn = entities.withColumn("attempt", F.lit(0)).withColumn("sur", new())
    for _ in range(most):
        drawn = stash(drawn, "surrogates")
        first = drawn.groupBy("kind", "sur").agg(F.min(F.struct("attempt", "canon")).alias("first"))
        checked = drawn.join(first, ["kind", "sur"]).join(real, ["kind", "sur"], "left")
        clash = F.col("is_real").isNotNull() | (F.col("first.canon") != F.col("canon"))
        checked = checked.withColumn("attempt", F.col("attempt") + clash.cast("int")).withColumn("clash", clash)
        if checked.where("clash").isEmpty():
            return drawn.select("kind", "canon", "sur")
        drawn = checked.withColumn("sur", F.when(F.col("clash"), new()).otherwise(F.col("sur"))).select(*drawn.columns)
    raise ValueError(f"no distinct surrogates after {most} draws: a format has too few values for its entities")


def with_persons(mentions: DataFrame) -> DataFrame:
    """Adds ``person``: the longest name of the document that a name is part of (itself, as a rule); of other kinds ``canon``."""
    names = mentions.where("kind = 'name'").groupBy("_id", "_hash")
    names = names.agg(F.sort_array(F.collect_set(F.struct((-F.length("canon")).alias("order"), "canon", "gender"))).alias("_known"))
    parts = F.split(F.lower("canon"), " ")

    def covers(other: Column) -> Column:
        theirs = F.split(F.lower(other.canon), " ")
        whole = F.forall(parts, lambda x: F.array_contains(theirs, x) | x.rlike(r"^\p{L}\.?$") & F.exists(theirs, lambda y: y.startswith(F.substring(x, 1, 1))))
        same = (other.gender == F.col("gender")) | (other.gender == "") | (F.col("gender") == "")
        return (F.length(other.canon) > F.length("canon")) & same & whole & F.array_contains(theirs, F.element_at(parts, -1))

    owner = F.get(F.filter("_known", covers), F.lit(0)).canon
    named = mentions.where("kind = 'name'").join(names, ["_id", "_hash"]).withColumn("person", F.coalesce(owner, F.col("canon"))).drop("_known")
    return mentions.where("kind <> 'name'").withColumn("person", F.col("canon")).unionByName(named)


def _part_of(token: Column, pairs: Column) -> Column:
    """The surrogate of a part of a name, in its letter case; null for other words."""
    new = F.get(F.filter(pairs, lambda p: p.old == F.lower(token)), F.lit(0)).new
    return F.when(_shouted(token), F.upper(new)).otherwise(new)


def _pairs(canon: Column, sur: Column) -> Column:
    old, new = F.split(F.lower(canon), " "), F.split(sur, " ")
    return F.transform(old, lambda x, at: F.struct(x.alias("old"), F.get(new, at).alias("new")))


def _short_form(canon: Column, core: Column, person: Column, sur: Column) -> Column:
    """The surrogate of a name that is part of ``person``'s."""
    pairs = _pairs(person, sur)

    def word(token: Column) -> Column:
        like = F.get(F.filter(pairs, lambda p: p.old.startswith(F.lower(F.substring(token, 1, 1)))), F.lit(0)).new
        short = F.when(token.rlike(f"^(?:{_INITIAL})$"), F.concat(F.substring(like, 1, 1), F.lit(".")))
        return F.coalesce(_part_of(token, pairs), short, token)

    new = F.array_join(F.transform(F.split(canon, " "), word), " ")
    return F.when(_shouted(core), F.upper(new)).otherwise(new)


def _untitled(part: Column, pairs: Column) -> Column:
    """``part`` of a text with the capitalised words that are part of a known name replaced."""
    tokens = F.regexp_extract_all(part, F.lit(_TOKEN), F.lit(0))

    def one(rest: Column, at: Column) -> Column:
        token = F.get(tokens, at)
        base, first = F.regexp_replace(token, _ENDING, ""), F.regexp_extract(token, r"^\p{L}+", 0)
        keep = lambda x: F.concat(_part_of(x, pairs), F.substring(token, F.length(x) + 1, F.length(token)))
        return F.concat(rest, F.coalesce(keep(base), keep(first), token, F.lit("")))

    return F.array_join(F.transform(F.split(part, _TOKEN, -1), one), "")


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and ``n_entities``, which replaces a column of that name; other columns are kept.

    Texts without an entity are not shuffled. Mentions meet their surrogates in a join by entity and return to
    their text by (doc_id, hash of the text).
    """
    prefix = "_pii"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    ents, digest, ident, subst, people = (f"{prefix}{c}" for c in ("ents", "hash", "id", "subs", "names"))
    docs = docs.drop("n_entities")
    columns = docs.columns
    # The pattern runs once over every text; what it found is kept beside the texts.
    found = docs.withColumns({ents: F.coalesce(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)), F.array()), digest: F.xxhash64("text"), ident: F.coalesce(F.col("doc_id").cast("string"), F.lit(""))})
    found = stash(found.withColumn("n_entities", F.size(ents)), "pii-texts")
    clean, hits = found.where("n_entities = 0"), found.where("n_entities > 0")
    mentions = parsed(hits.select(F.col(ident).alias("_id"), F.col(digest).alias("_hash"), F.posexplode(ents).alias("pos", "entity")))
    mapping = assign_surrogates(mentions.select("kind", "canon", "gender"), key)
    mapping = mapping.withColumnRenamed("canon", "person")
    short = (F.col("kind") == "name") & (F.col("person") != F.col("canon"))
    new = F.when(short, _short_form(F.col("canon"), F.col("core"), F.col("person"), F.col("sur"))).otherwise(rendered(F.col("core"), F.col("kind"), F.col("sur")))
    sub = F.struct("pos", F.concat("lead", new, "tail").alias("new"))
    name = F.when(F.col("kind") == "name", F.struct((-F.length("person")).alias("order"), "person", "sur"))
    subs = with_persons(mentions).join(mapping, ["kind", "person"]).select("_id", "_hash", sub.alias("sub"), name.alias("name"))
    subs = subs.groupBy("_id", "_hash").agg(F.sort_array(F.collect_set("sub")).alias("_subs"), F.sort_array(F.collect_set("name")).alias("_names"))
    # longer names first
    subs = subs.withColumn("_names", F.flatten(F.transform("_names", lambda x: _pairs(x.person, x.sur))))
    subs = subs.select(F.col("_id").alias(ident), F.col("_hash").alias(digest), F.col("_subs").alias(subst), F.col("_names").alias(people))
    parts = F.split("text", PATTERN, -1)
    parts = F.when(F.size(people) > 0, F.transform(parts, lambda part: _untitled(part, F.col(people)))).otherwise(parts)
    text = F.array_join(F.transform(parts, lambda part, at: F.concat(part, F.coalesce(F.get(F.col(f"{subst}.new"), at), F.lit("")))), "")
    changed = hits.join(subs, [ident, digest]).withColumn("text", text)
    return clean.select(*columns, "n_entities").unionByName(changed.select(*columns, "n_entities"))
