"""Personal data and secrets in texts, replaced by surrogates, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, unused

# What an entity of each kind looks like. The order decides where two could start.
KINDS = {
    "email": r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "phone": r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\d)|\+(?=\d(?:[ .-]?\(?\d\)?){6})\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\d)",
    "secret": r"(?<![\p{L}\p{N}])(?=[\p{L}\p{N}_-]*\d)(?=[\p{L}\p{N}_-]*\p{L})[A-Za-z0-9_-]{24,}(?![\p{L}\p{N}])",
    "name": r"(?<=\b(?:Mr|Mrs|Ms|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Господин|Госпожа)\.? )\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?",
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
# Titles that say what names follow, and names to choose from by gender and script.
FEMALE = r"(?:Mrs|Ms|Frau|Madame|Mme|Señora|Sra|Госпожа)"
NAMES = {
    "latin m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo", "Martin", "Noel", "Oscar", "Paul"],
    "latin f": ["Alma", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irene", "Julia", "Karin", "Laura", "Marta", "Nora", "Olga", "Paula"],
    "cyrillic m": ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Игорь", "Кирилл"],
    "cyrillic f": ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Ксения", "Лидия"],
}
SYLLABLES = {
    "latin": ["ba", "den", "kor", "li", "mar", "ne", "ro", "sel", "ta", "ver", "wi", "zan", "gal", "hem", "po", "ril"],
    "cyrillic": ["ба", "ден", "кор", "ли", "мар", "не", "ро", "сел", "та", "вер", "ви", "зан", "гал", "хем", "по", "рил"],
}


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _kind(entity: Column) -> Column:
    out = F.lit("secret")
    for kind, pattern in reversed(KINDS.items()):
        if kind not in ("secret", "name"):
            out = F.when(entity.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return F.when(entity.rlike(r"^\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?$"), F.lit("name")).otherwise(out)


def _by_kind(kind: Column, values: dict[str, Column], otherwise: Column) -> Column:
    out = otherwise
    for name, value in values.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def _canonical(kind: Column, entity: Column) -> Column:
    """What is the same in all spellings of one entity: the digits of numbers, the lower case of words."""
    digits = F.regexp_replace(entity, r"\D", "")
    # a national number is the same as the one with the country's 1 in front
    phone = F.when(F.length(digits) == 11, F.regexp_replace(digits, "^1", "")).otherwise(digits)
    plain = F.upper(F.regexp_replace(entity, " ", ""))
    return _by_kind(kind, {"phone": phone, "card": digits, "ssn": digits, "iban": plain, "secret": entity}, F.lower(entity))


def _stream(key: str, *parts: Column) -> Column:
    """64 keyed hexadecimal digits."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *(p.cast("string") for p in parts)), 256)


def _pick(stream: Column, at: Column | int, among: int) -> Column:
    """A number below ``among`` from six digits of the stream."""
    return F.conv(F.substring(stream, F.lit(at) if isinstance(at, int) else at, F.lit(6)), 16, 10).cast("bigint") % among


def _characters(model: Column, key: str, *parts: Column) -> Column:
    """A text like ``model``: digits for digits, letters for letters of the same case, the rest as it is.

    What could be a hexadecimal number stays one.
    """
    letters = F.when(model.rlike("^[0-9a-fA-F]+$"), 6).otherwise(26)

    def one(c: Column, i: Column) -> Column:
        # each character has six digits of a stream, a new stream for every ten characters
        n = _pick(_stream(key, *parts, F.floor(i / 10)), (i % 10) * 6 + 1, 1 << 24)
        digit = (n % 10).cast("string")
        nth = (n % letters + 1).cast("int")
        low, high = F.substring(F.lit(LETTERS), nth, F.lit(1)), F.substring(F.lit(LETTERS.upper()), nth, F.lit(1))
        return F.when(c.rlike(r"^\d$"), digit).when(c.rlike(r"^\p{Lu}$"), high).when(c.rlike(r"^\p{L}$"), low).otherwise(c)

    return F.array_join(F.transform(F.split(model, ""), one), "")


def _luhn(digits: Column) -> Column:
    """``digits`` with the last one set so that the check sum holds."""
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    twice = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
    doubled = F.transform(
        F.split(F.reverse(body), ""), lambda c, i: F.when(i % 2 == 0, twice(c.cast("int"))).otherwise(c.cast("int"))
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def _surrogate(key: str, kind: Column, canon: Column, group: Column, tries: Column) -> Column:
    """A canonical form of the same kind, chosen by the key, the entity and the number of tries."""
    like = _characters(canon, key, kind, canon, tries)
    s = _stream(key, kind, canon, tries)
    domain = F.regexp_extract(canon, r"(\.[\p{L}\p{N}-]+)$", 1)  # the kind of domain stays
    local = _characters(F.substring(canon, F.lit(1), F.length(canon) - F.length(domain)), key, kind, canon, tries)
    # where a format has too few values for its entities, later tries draw from more: from longer and longer forms
    longer = F.greatest(F.lit(0), F.least(tries - 5, F.lit(40)))
    digits = _characters(F.repeat(F.lit("0"), longer), key, kind, canon, tries, F.lit("longer"))
    signs = F.substring(_stream(key, kind, canon, tries, F.lit("longer")), F.lit(1), longer)
    email = F.concat(F.when(tries < 6, F.lit("")).otherwise(F.substring(s, F.lit(1), longer + 5)), local, domain)
    network = F.when(tries < 4, F.lit("10")).otherwise((_pick(s, 19, 223) + 1).cast("string"))
    octets = F.concat_ws(".", network, *(_pick(s, at, 256).cast("string") for at in (1, 7, 13)))
    iban = F.concat(F.substring(canon, 1, 2), _characters(F.substring(canon, F.lit(3), F.length(canon)), key, kind, canon, tries), digits)
    # a card keeps its first digit, which names the issuer's kind
    card = _luhn(F.concat(F.substring(canon, 1, 1), F.substring(like, F.lit(2), F.length(like)), digits))

    # a family name is drawn by itself; its group is the script
    s2, family = _stream(key, F.lit("family"), canon, tries), F.lit(None).cast("string")
    for script, values in SYLLABLES.items():
        # more syllables with every try, so that there is always a name left
        family = F.when(group == script, _syllables(s2, values, F.least(tries + 3, F.lit(8)))).otherwise(family)
    family = F.lower(family)
    return _by_kind(kind, {"email": email, "ip": octets, "iban": iban, "card": card, "family": family, "secret": F.concat(like, signs)}, F.concat(like, digits))


def _syllables(stream: Column, values: list[str], n: Column) -> Column:
    """``n`` of the syllables, at most 8."""
    nth = lambda i: (_pick(stream, (i * 6 + 1).cast("int"), len(values)) + 1).cast("int")
    return F.array_join(F.transform(F.slice(F.sequence(F.lit(2), F.lit(9)), F.lit(1), n), lambda i: F.element_at(F.array(*map(F.lit, values)), nth(i))), "")


def _full_name(key: str, group: Column, canon: Column, family: Column, tries: Column) -> Column:
    """A given name of the group before the family's surrogate; later tries add syllables to the given name."""
    first = F.substring_index(canon, " ", 1)
    s = _stream(key, group, first, tries)
    # later tries depend on the family too, so that two people who collide once do not go on colliding
    s = F.when(tries == 0, s).otherwise(_stream(key, group, canon, tries))
    given = F.lit(None).cast("string")
    for name, values in NAMES.items():
        one = F.element_at(F.array(*map(F.lit, values)), (_pick(s, 1, len(values)) + 1).cast("int"))
        more = _syllables(s, SYLLABLES[name.split(" ")[0]], F.least(tries, F.lit(8)))
        given = F.when(group == name, F.concat(one, more)).otherwise(given)
    return F.lower(F.concat_ws(" ", given, family))


def _written(kind: Column, raw: Column, canon: Column, surrogate: Column) -> Column:
    """The surrogate in the format of this occurrence; what is longer than the format follows it."""
    digits = F.regexp_replace(raw, r"\D", "")
    # a country's number in front is no part of the canonical form, and stays
    lead = F.length(digits) - F.length(canon)
    rest = F.substring(surrogate, F.length(canon) + 1, F.length(surrogate))
    slots = F.split(raw, "")
    nth = F.transform(slots, lambda c, i: F.length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), r"\D", "")))
    filled = F.zip_with(slots, nth, lambda c, n: F.when(c.rlike(r"^\d$") & (n > lead), F.substring(surrogate, n - lead, F.lit(1))).otherwise(c))
    until = lambda i: F.length(F.replace(F.substring(raw, F.lit(1), i + 1), F.lit(" "), F.lit("")))
    spaced = F.transform(slots, lambda c, i: F.when(c == " ", c).otherwise(F.substring(surrogate, until(i), F.lit(1))))
    capital = lambda i: F.substring(raw, i + 1, F.lit(1)).rlike(r"\p{Lu}")
    cased = F.transform(F.split(surrogate, ""), lambda c, i: F.when(capital(i), F.upper(c)).otherwise(c))
    forms = {**dict.fromkeys(("phone", "card", "ssn"), F.concat(F.array_join(filled, ""), rest)), "iban": F.concat(F.array_join(spaced, ""), rest)}
    return _by_kind(kind, {**forms, "name": F.initcap(surrogate), "email": F.array_join(cased, "")}, surrogate)


def entities(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc, text_hash, pos, raw, kind, canon, grp)`` of each entity; ``pos`` counts the entities of a text."""
    text = F.col(text_column)
    # a name's gender is in the title before it, so the text before each entity is cut out too
    own = [F.col(id_column).cast("bigint").alias("doc"), F.xxhash64(text).alias("text_hash"), text.alias("t")]
    cut = docs.select(*own, F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1)).alias("found")).filter(F.size("found") > 0)
    before = F.transform(F.split("t", ANY), lambda p: F.regexp_extract(p, rf"({FEMALE})\.? $", 1) != "")
    each = F.arrays_zip(F.col("found").alias("raw"), F.slice(before, F.lit(1), F.size("found")).alias("female"))
    cut = cut.select("doc", "text_hash", F.posexplode(each).alias("pos", "e"))
    kind = _kind(F.col("e.raw"))
    script = F.when(F.col("e.raw").rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    gender = F.when(F.instr("e.raw", " ") == 0, F.lit("")).when(F.col("e.female"), F.lit(" f")).otherwise(F.lit(" m"))
    group = F.when(kind == "name", F.concat(script, gender)).otherwise(F.lit(""))
    out = cut.select("doc", "text_hash", "pos", F.col("e.raw").alias("raw"), kind.alias("kind"), group.alias("grp"))
    return out.withColumn("canon", _canonical(F.col("kind"), F.col("raw")))


def surrogates(found: DataFrame, key: str, most_tries: int = 60) -> DataFrame:
    """``(kind, grp, canon, surrogate)``: no two entities of a kind share a surrogate, and none is another's real value.

    Each family name has one surrogate, alone and after all given names; full names that
    would be the same have their given names drawn again.
    """
    own = ["kind", "grp", "canon"]
    known = stored(found.select(own).distinct(), "entities")
    names = known.filter("kind = 'name'")
    last = F.substring_index("canon", " ", -1).alias("last")
    script = F.substring_index("grp", " ", 1).alias("script")
    families = names.select(F.lit("family").alias("kind"), script.alias("grp"), last.alias("canon")).distinct()
    single = known.filter("kind <> 'name'").unionByName(families)
    draw = lambda tries: _surrogate(key, F.col("kind"), F.col("canon"), F.col("grp"), tries)
    ready = stored(_drawn(stored(single, "entities"), draw, most_tries), "surrogates")
    family = ready.filter("kind = 'family'").select(F.col("grp").alias("script"), F.col("canon").alias("last"), F.col("surrogate").alias("family"))
    named = stored(names.select(*own, script, last).join(family, ["script", "last"]).select(*own, "family"), "entities")
    alone = named.filter("instr(canon, ' ') = 0").select(*own, F.col("family").alias("surrogate"))
    full = named.filter("instr(canon, ' ') > 0")
    draw = lambda tries: _full_name(key, F.col("grp"), F.col("canon"), F.col("family"), tries)
    return ready.filter("kind <> 'family'").unionByName(alone).unionByName(_drawn(full, draw, most_tries).select(*own, "surrogate"))


def _drawn(known: DataFrame, draw: Callable[[Column], Column], most_tries: int) -> DataFrame:
    """``known`` and ``surrogate``, drawn again while two entities of a kind share one or it is a real one."""
    columns = known.columns
    ready, todo = None, known
    for n in range(most_tries):
        now = todo.withColumn("surrogate", draw(F.lit(n)))
        if ready is not None:
            taken = ready.select("kind", "surrogate").distinct()
            now = now.join(taken.withColumn("taken", F.lit(True)), ["kind", "surrogate"], "left")
        else:
            now = now.withColumn("taken", F.lit(False))
        real = known.select("kind", F.col("canon").alias("surrogate")).distinct().withColumn("real", F.lit(True))
        now = now.join(real, ["kind", "surrogate"], "left")
        first = now.groupBy("kind", "surrogate").agg(F.min(F.concat_ws("\x1f", "grp", "canon")).alias("first"))
        now = now.join(first, ["kind", "surrogate"])
        good = ~F.coalesce("taken", F.lit(False)) & ~F.coalesce("real", F.lit(False)) & (F.concat_ws("\x1f", "grp", "canon") == F.col("first"))
        now = stored(now.select(*columns, "surrogate", good.alias("good")), "surrogates")
        done = now.filter("good").drop("good")
        ready = done if ready is None else ready.unionByName(done)
        todo = now.filter("not good").select(columns)
        if todo.isEmpty():
            return ready
    raise ValueError(f"no free surrogates after {most_tries} tries: a format has too few values for its entities")


def replace_pii(docs: DataFrame, key: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with each detected entity replaced, and ``entities_replaced``.

    Detected are e-mail and IP addresses, phone, card, social security and bank account
    numbers, long tokens of letters and digits, and names after a title. A surrogate has
    the kind and the format of the entity: as many digits with the same signs between them,
    the same case, a valid check digit for cards, a name of the same gender and script.
    Which one depends on ``key`` and the entity only, so an entity has the same surrogate
    in all documents and spellings. A surrogate that another entity has, or that is a real
    entity of the corpus, is drawn again; where a format has too few free values for that,
    later draws are longer than the entity. A number after ``+`` is a phone from seven digits on.

    A null text stays null, with 0 replaced, and an empty one empty. Repeated rows get the
    same text. A null id is a document like any other. Columns keep their names and order;
    ``entities_replaced`` is replaced.
    """
    found = stored(entities(docs, id_column=id_column, text_column=text_column), "pii")
    named = surrogates(found, key)
    # a surrogate is looked up by the entity; one in very many texts is a long run that adaptive execution splits
    here = _written(F.col("kind"), F.col("raw"), F.col("canon"), F.col("surrogate")).alias("new")
    written = found.join(stored(named, "surrogate-table"), ["kind", "grp", "canon"]).select("doc", "text_hash", "pos", here)
    spots = stored(written, "pii-new").groupBy("doc", "text_hash", "pos").agg(F.min("new").alias("new"))
    in_order = F.sort_array(F.collect_list(F.struct("pos", "new")))
    by_text = spots.groupBy("doc", "text_hash").agg(F.transform(in_order, lambda x: x["new"]).alias("all"))
    kept = [c for c in docs.columns if c != "entities_replaced"]
    of, hashed, ours, new = (unused(kept, c) for c in ("of", "hashed", "ours", "new"))
    by_text = by_text.select(F.col("doc").alias(of), F.col("text_hash").alias(hashed), F.col("all").alias(new))
    text = F.col(text_column)
    same = F.col(id_column).cast("bigint").eqNullSafe(F.col(of)) & (F.col(ours) == F.col(hashed))
    # sorted and merged at any size: a plan that changed with it would be hard to foresee
    both = docs.select(*kept, F.xxhash64(text).alias(ours)).join(by_text.hint("merge"), same, "left")
    parts = F.split(text, ANY, -1)
    joined = F.array_join(F.zip_with(parts, new, lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    changed = F.when(F.col(new).isNull(), text).otherwise(joined)
    return both.select(*(changed.alias(c) if c == text_column else F.col(c) for c in kept), F.coalesce(F.size(new), F.lit(0)).alias("entities_replaced"))
