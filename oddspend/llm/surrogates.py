"""Personal data replaced by surrogates, with column expressions only.

Entities (e-mail addresses, phone, card and social security numbers, account numbers, IP
addresses, names of people) are normalised: one address in two spellings, one number in two
formats, one surname with and without a given name are one entity, and get one surrogate
wherever they stand (coreference). A given name or surname found in a document is also replaced
where it stands alone there. A number with and without its country code is two entities. Surrogates are drawn from SHA-256 of a key, the type, the
normal form and an attempt, in the entity's own type and format: digits for digits in the
same grouping (card numbers keep a valid check digit), letters for letters, names by gender
and script. Distinct entities get distinct surrogates: of those that draw the same one the
smallest keeps it, others try again, as does who draws an entity of the corpus or a surrogate
already given. The sets of names and addresses grow with the attempts. Numbers keep their format,
so their space is bounded: the search raises after ATTEMPTS draws, when it is all but full. Network
addresses and social security numbers come from ranges that nobody has.

The texts are read for entities once, behind a cheap test of what every entity holds.

Entities are pre-aggregated per document and by partial aggregation; the join back sends
(document, entity) rows without text, which Spark splits where an entity is hot. The new texts
meet the documents in one join by id and hash of the text; rows that share both share the text.

Null texts stay null, empty texts empty; texts without an entity are unchanged. Rows with
one id and one text are handled alike; extra columns are kept whatever their names; an empty
table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, functions as F

from oddspend.llm.expressions import let
from oddspend.session import materialize

#: Fixed titles and common given names that announce a person, by gender (f, m; x for either).
TITLES = {"f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Sra", "Madame", "Госпожа"), "m": ("Mr", "Herr", "Sr", "Monsieur", "Señor", "Господин"), "x": ("Dr", "Prof")}
GIVEN = {
    "f": "Mary Patricia Jennifer Linda Elizabeth Susan Jessica Sarah Karen Lisa Nancy Emily Emma Olivia Sophia Anna Maria Laura Julia Claudia Petra Sabine Isabelle Camille Carmen Lucía Анна Мария Елена Ольга".split(),
    "m": "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Peter Paul Andreas Stefan Wolfgang Jürgen Pierre François Carlos José Juan Иван Дмитрий Сергей Алексей".split(),
}

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"
_NAME = r"\p{Lu}(?:['’]\p{Lu})?\p{L}+(?:-\p{Lu}\p{L}+)*+"
_TITLE = "(?:" + "|".join(x for g in TITLES.values() for t in g for x in (t, t.upper())) + r")\.?"
_GIVEN = "(?:" + "|".join(x for g in GIVEN.values() for n in g for x in (n, n.upper())) + ")"
#: With a leading 0 (pairs; area code and rest; code in brackets), nine digits from 6 to 9, or ten or so in one piece.
_NATIONAL = (
    r"(?<![A-Za-z0-9]|[0-9][ .,/-]|[.,/-])(?:0[1-9](?:[ .-][0-9]{2}){4}|\(0[0-9]{1,4}\) ?[0-9]{2,8}(?:[ -][0-9]{2,4}){0,3}"
    r"|0[0-9]{2,4}[ /-](?:[0-9]{5,8}|[0-9]{2,4}(?:[ -][0-9]{2,4}){1,3})|[6-9][0-9]{2}(?:(?:[ -][0-9]{3}){2}|(?:[ -][0-9]{2}){3})"
    r"|0[1-9][0-9]{8,10}|[2-9][0-9]{2}[2-9][0-9]{6})(?![A-Za-z0-9]|[ .,/-][0-9])"
)
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9.])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![A-Za-z0-9])",
    "ip": rf"(?<![A-Za-z0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![A-Za-z0-9]|\.[0-9])",
    "ipv6": rf"(?<![A-Za-z0-9:.])(?={_HEX}:|::)(?=[A-Fa-f:]*[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|(?:{_HEX}:){{1,7}}:|:(?::{_HEX}){{1,7}})(?![A-Za-z0-9:])",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    "phone": r"(?<![A-Za-z0-9])\+[1-9](?:[ .-]?\(?[0-9]\)?){6,14}(?![A-Za-z0-9])|" + _NATIONAL + r"|(?<![A-Za-z0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{4}(?![A-Za-z0-9])|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![A-Za-z0-9])",
    "name": rf"(?<!\p{{L}})(?:{_TITLE} {_NAME}(?: {_NAME})?|{_GIVEN} {_NAME})(?!\p{{L}})",
}
#: A word that may be a name standing alone.
ALONE = r"(?<!\p{L})" + _NAME + r"(?!\p{L})"
#: Fixed surnames that are words too: before a word in small letters they are taken for the word.
HOMOGRAPHS = "black brown green gray grey white young long short small little rich price day may king bishop hall wood stone field hill lake rivers snow summers winter frost banks bush rose love hope best good swift strong wise fox wolf park grant mark will".split()
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every match of ANY holds: an @, four digits close together, two colons, the core of an account
#: number, or a capital that starts a title or given name before a capital. Cheap where there is none.
_ANNOUNCED = sorted({x for g in (*TITLES.values(), *GIVEN.values()) for w in g for x in (w, w.upper())})
MAY_HOLD = (
    r"@|[0-9](?:[ ./()-]{0,3}[0-9]){3}|:[0-9A-Fa-f]{0,4}:|[0-9]{2}(?: ?[A-Z0-9]{4}){3}"
    rf"|[{''.join(sorted({w[0] for w in _ANNOUNCED}))}](?<!\p{{L}}.)(?:{'|'.join(sorted({w[1:] for w in _ANNOUNCED}))})\.? \p{{Lu}}"
)
DIGITS = ("card", "ssn", "phone")
ATTEMPTS = 256  # a draw fails as often as its space is taken: with nine tenths taken, one in 5 * 10^11 entities fails as many
SYLLABLES = {"latin": "ba be bi da de di fa fe ga ge ka ke la le li ma me mi na ne ni ra re ri sa se ta te va vi".split(), "cyrillic": "ба бе ви да де ди га ка ла ле ма ми на не ни ра ре ри са се та те ва ви за зо".split()}
ENDINGS = {"latin": {"given_f": "na", "given_m": "ron", "given_x": "ren", "surname": "ler"}, "cyrillic": {"given_f": "на", "given_m": "рон", "given_x": "рен", "surname": "лер"}}
#: Reserved for examples, so that no surrogate address belongs to anyone.
DOMAINS = ("example.com", "example.org", "example.net")


def kind_of(match: Column) -> Column:
    """The type of a match of ANY."""
    out = F.when(F.contains(match, F.lit("@")), "email").when(F.contains(match, F.lit(":")), "ipv6")
    for kind in ("ip", "account", "card", "ssn"):
        out = out.when(match.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return out.when(match.rlike(r"^\p{L}"), "name").otherwise("phone")


def _one_of(words, value: Column) -> Column:
    return value.isin(*words)


def _eight_groups(address: Column) -> Column:
    """An IPv6 address with all its zeros, in lower case."""
    def groups(side: Column) -> Column:
        return F.transform(F.filter(F.split(F.coalesce(side, F.lit("")), ":"), lambda g: g != ""), lambda g: F.lpad(g, 4, "0"))

    def of(sides: Column) -> Column:
        left, right = groups(F.get(sides, F.lit(0))), groups(F.get(sides, F.lit(1)))
        zeros = F.array_repeat(F.lit("0000"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
        return F.array_join(F.concat(left, zeros, right), ":")

    return let(F.split(F.lower(address), "::"), of)


def parts(match: Column) -> Column:
    """The entities in a match, in order of place: (type, normal form)."""
    def entity(kind, norm):
        return F.struct(kind.alias("type"), norm.alias("norm"))

    def name(tokens: Column) -> Column:
        title = F.initcap(F.regexp_replace(tokens[0], r"\.$", ""))
        titled = _one_of([t for g in TITLES.values() for t in g], title)
        given = F.when(titled & (F.size(tokens) == 3), tokens[1]).when(~titled, tokens[0])
        gender = F.when(_one_of(TITLES["f"], title) | _one_of(GIVEN["f"], F.initcap(given)), "given_f").when(_one_of(TITLES["m"], title) | _one_of(GIVEN["m"], F.initcap(given)), "given_m").otherwise("given_x")
        # one person's given name keeps its gender whatever the title: the lists come before titles
        gender = F.when(_one_of(GIVEN["f"], F.initcap(given)), "given_f").when(_one_of(GIVEN["m"], F.initcap(given)), "given_m").otherwise(gender)
        surname = F.array(entity(F.lit("surname"), F.lower(F.element_at(tokens, -1))))
        return F.when(given.isNotNull(), F.concat(F.array(entity(gender, F.lower(given))), surname)).otherwise(surname)

    def of(kind: Column) -> Column:
        plain = F.when(kind.isin(*DIGITS), F.regexp_replace(match, "[^0-9]", "")).when(kind == "account", F.replace(match, F.lit(" "), F.lit(""))).when(kind == "ipv6", _eight_groups(match)).otherwise(F.lower(match))
        return F.when(kind == "name", let(F.split(match, " "), name)).otherwise(F.array(entity(kind, plain)))

    return let(kind_of(match), of)


def _drawn(key: str, kind: Column, norm: Column, attempt: int, block: int) -> Column:
    """32 numbers of 0 to 255 from the keyed hash."""
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, norm, F.lit(str(attempt)), F.lit(str(block))), 256)
    return let(seed, lambda h: F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.conv(F.substr(h, 2 * i + 1, F.lit(2)), 16, 10).cast("int")))


def _check_digit(digits: Column) -> Column:
    """The digit that makes these and it a valid card number."""
    n = F.size(digits)
    total = F.aggregate(
        F.transform(digits, lambda d, i: let(d.cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x))),
        F.lit(0), lambda a, x: a + x,
    )
    return ((10 - total % 10) % 10).cast("string")


def candidate(key: str, kind: Column, norm: Column, attempt: int) -> Column:
    """The surrogate of an entity at this attempt, in normal form."""
    numbers = F.concat(*[_drawn(key, kind, norm, attempt, b) for b in range(2)])

    def draw(r: Column) -> Column:
        at = lambda i: F.get(r, i % 64)
        letters, chars = F.lit("abcdefghijklmnopqrstuvwxyz"), F.split(norm, "")
        swap = F.transform(chars, lambda c, i: F.when(c.rlike("[0-9]"), (at(i) % 10).cast("string")).when(c.rlike("[a-z]"), F.substr(letters, at(i) % 26 + 1, F.lit(1))).when(c.rlike("[A-Z]"), F.upper(F.substr(letters, at(i) % 26 + 1, F.lit(1)))).otherwise(c))
        local = F.array_join(F.slice(swap, 1, F.greatest(F.instr(norm, "@") - 1, F.lit(0))), "")
        # later attempts add letters: the set of addresses is not bounded by a short local part
        extra = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(max(1, attempt))), lambda i: F.substr(letters, at(i + 40) % 26 + 1, F.lit(1))), "") if attempt else F.lit("")
        email = F.concat(local, extra, F.lit("@"), F.get(F.array(*map(F.lit, DOMAINS)), at(F.lit(63)) % 3))
        # no host has an address of this range
        ip = F.concat_ws(".", (at(F.lit(0)) % 15 + 240).cast("string"), *[at(F.lit(k)).cast("string") for k in (1, 2, 3)])
        # the prefix reserved for examples
        ipv6 = F.concat(F.lit("2001:0db8"), *[F.concat(F.lit(":" if k % 2 == 0 else ""), F.lower(F.lpad(F.hex(at(F.lit(k)).cast("bigint")), 2, "0"))) for k in range(12)])
        lead = F.slice(chars, 1, 1)  # the first digit tells kinds of cards apart
        body = F.concat(lead, F.slice(swap, 2, F.greatest(F.size(chars) - 2, F.lit(0))))
        valid = _check_digit(F.slice(chars, 1, F.greatest(F.size(chars) - 1, F.lit(0)))) == F.element_at(chars, -1)
        card = F.concat(F.array_join(body, ""), F.when(valid, _check_digit(body)).otherwise(F.element_at(swap, -1)))
        # the country code of long numbers, the leading 0 of national ones
        country = F.when(kind == "phone", F.when(F.startswith(norm, F.lit("0")), 1).otherwise(F.greatest(F.size(chars) - 10, F.lit(0)))).otherwise(0)
        digits = F.concat(F.slice(chars, 1, country), F.slice(swap, country + 1, F.size(chars)))
        ssn = F.concat(F.lit("9"), F.array_join(F.slice(swap, 2, F.size(chars)), ""))  # none is issued with a 9 first
        account = F.concat(F.array_join(F.slice(chars, 1, 2), ""), F.array_join(F.slice(swap, 3, F.size(swap)), ""))

        def made(script: str) -> Column:
            syllables = F.array(*map(F.lit, SYLLABLES[script]))
            stem = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2 + attempt)), lambda i: F.get(syllables, at(i) % len(SYLLABLES[script]))), "")
            end = F.when(F.lit(False), "")
            for k, v in ENDINGS[script].items():
                end = end.when(kind == k, v)
            return F.concat(stem, end)

        person = F.when(norm.rlike(r"\p{IsCyrillic}"), made("cyrillic")).otherwise(made("latin"))
        return (
            F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ipv6", ipv6).when(kind == "card", card).when(kind == "account", account)
            .when(kind == "ssn", ssn).when(kind.isin(*DIGITS), F.array_join(digits, "")).otherwise(person)
        )

    return let(numbers, draw)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """type, norm, surrogate for each distinct (type, norm); no two entities of a type share
    one, and none is itself an entity of the corpus."""
    entities = materialize(entities.select("type", "norm").distinct(), "entities")
    left, done, attempt = entities, None, 0
    while True:
        drawn = left.withColumn("surrogate", candidate(key, F.col("type"), F.col("norm"), attempt))
        first = drawn.groupBy("type", "surrogate").agg(F.min("norm").alias("norm"))
        first = first.join(entities.select("type", F.col("norm").alias("surrogate")), ["type", "surrogate"], "left_anti")
        if done is not None:
            first = first.join(done.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        first = first.select("type", "norm", "surrogate")
        done = materialize(first if done is None else done.unionByName(first), "surrogates")
        left = entities.join(done, ["type", "norm"], "left_anti")
        if left.isEmpty():
            return done
        left, attempt = materialize(left, "entities_left"), attempt + 1
        if attempt == ATTEMPTS:
            full = [tuple(r) for r in left.groupBy("type", F.regexp_replace(F.regexp_replace("norm", "[0-9]", "0"), "[a-z]", "a").alias("form")).count().limit(5).collect()]
            raise ValueError(f"no free surrogates left for (type, form, entities) {full}")


def _render(match: Column, known: Column) -> Column:
    """The match in its own format with the surrogates of its entities."""
    def found(e: Column) -> Column:
        return F.try_element_at(known, F.concat_ws(":", e["type"], e["norm"]))

    def fill(digits: Column) -> Column:
        start = F.struct(F.lit(0).alias("used"), F.lit("").alias("text"))
        step = lambda s, c: F.when(c.rlike("[0-9]"), F.struct((s["used"] + 1).alias("used"), F.concat(s["text"], F.substr(digits, s["used"] + 1, F.lit(1))).alias("text"))).otherwise(F.struct(s["used"].alias("used"), F.concat(s["text"], c).alias("text")))
        return F.aggregate(F.split(match, ""), start, step, lambda s: s["text"])

    def grouped(text: Column) -> Column:
        start = F.struct(F.lit(0).alias("used"), F.lit("").alias("text"))
        step = lambda s, c: F.when(c != " ", F.struct((s["used"] + 1).alias("used"), F.concat(s["text"], F.substr(text, s["used"] + 1, F.lit(1))).alias("text"))).otherwise(F.struct(s["used"].alias("used"), F.concat(s["text"], c).alias("text")))
        return F.aggregate(F.split(match, ""), start, step, lambda s: s["text"])

    def name(e: Column) -> Column:
        old = F.slice(F.split(match, " "), -F.size(e), F.size(e))
        names = F.transform(F.arrays_zip(e.alias("e"), old.alias("old")), lambda x: _cased(found(x["e"]), x["old"]))
        title = F.when(F.size(F.split(match, " ")) > F.size(e), F.slice(F.split(match, " "), 1, 1)).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.concat(title, names), " ")

    def of(e: Column) -> Column:
        kind = e[0]["type"]
        return F.when(kind.isin(*DIGITS), fill(found(e[0]))).when(kind == "account", grouped(found(e[0]))).when(kind.isin("email", "ip", "ipv6"), found(e[0])).otherwise(name(e))

    return let(parts(match), of)


def _cased(new: Column, old: Column) -> Column:
    """The surrogate of a name, in capitals throughout if the name is."""
    return F.when(old == F.upper(old), F.upper(new)).otherwise(F.initcap(new))


def _alone(gap: Column, known: Column, people: Column) -> Column:
    """(text, n): a text between matches with the names that stand alone in it replaced, and their number."""
    def surrogate(word: Column) -> Column:
        kinds = ("surname", "given_f", "given_m", "given_x")
        found = F.coalesce(*[F.try_element_at(known, F.concat(F.lit(f"{k}:"), F.lower(word))) for k in kinds])
        return F.when(F.array_contains(people, F.lower(word)), _cased(found, word))

    def of(words: Column) -> Column:
        after = F.split(gap, ALONE, -1)  # what follows word i is element i + 1
        a_word = lambda w, i: F.lower(w).isin(HOMOGRAPHS) & F.get(after, i + 1).rlike(r"^ \p{Ll}")
        new = F.transform(words, lambda w, i: F.when(~a_word(w, i), surrogate(w)))
        return let(new, lambda x: F.struct(
            F.array_join(F.transform(F.arrays_zip(F.split(gap, ALONE, -1).alias("gap"), words.alias("old"), x.alias("new")), lambda p: F.concat(p["gap"], F.coalesce(p["new"], p["old"], F.lit("")))), "").alias("text"),
            F.size(F.filter(x, lambda y: y.isNotNull())).alias("n")))

    same = F.struct(gap.alias("text"), F.lit(0).alias("n"))
    return F.when(F.size(people) > 0, let(F.regexp_extract_all(gap, F.lit(ALONE), F.lit(0)), of)).otherwise(same)


def replace(docs: DataFrame, key: str, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """docs with personal data replaced, plus n_entities (named so unless docs has it)."""
    names = docs.columns
    own = lambda base: base if base not in names else own(base + "_")
    number = own("n_entities")
    rows = docs.select(F.coalesce(F.col(ident).cast("string"), F.lit("")).alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    held = rows.filter(F.col("text").rlike(MAY_HOLD)).filter(F.col("text").rlike(ANY)).select(
        "id", "hash", F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("matches"), F.split("text", ANY, -1).alias("gaps"))
    held = materialize(held, "documents_with_entities")  # the only pass over all texts
    entities = held.select("id", "hash", F.explode(F.array_distinct(F.flatten(F.transform("matches", parts)))).alias("e"))
    entities = materialize(entities.select("id", "hash", "e.type", "e.norm").distinct(), "document_entities")
    table = assign(entities, key)
    known = entities.join(table, ["type", "norm"]).groupBy("id", "hash").agg(F.collect_set(F.struct(F.concat_ws(":", "type", "norm").alias("k"), F.col("surrogate").alias("v"))).alias("pairs"))
    found = held.dropDuplicates(["id", "hash"]).join(known.select("id", "hash", F.map_from_entries("pairs").alias("known")), ["id", "hash"])
    found = found.withColumn("people", F.transform(F.filter(F.map_keys("known"), lambda k: k.rlike("^(?:given_.|surname):")), lambda k: F.substring_index(k, ":", -1)))
    found = found.withColumn("gaps", F.transform("gaps", lambda g: _alone(g, F.col("known"), F.col("people"))))
    pieces = F.arrays_zip(F.transform("gaps", lambda g: g["text"]).alias("gap"), F.transform("matches", lambda m: _render(m, F.col("known"))).alias("new"))
    whole = F.array_join(F.transform(pieces, lambda p: F.concat(p["gap"], F.coalesce(p["new"], F.lit("")))), "")
    alone = F.aggregate("gaps", F.lit(0), lambda n, g: n + g["n"])
    new = found.select(F.col("id").alias(own("_id")), F.col("hash").alias(own("_hash")), whole.alias(own("_new")), (F.size("matches") + alone).cast("bigint").alias(number))
    new = materialize(new, "texts_with_surrogates")
    same = (F.coalesce(F.col(ident).cast("string"), F.lit("")) == F.col(own("_id"))) & (F.xxhash64(F.col(text)) == F.col(own("_hash")))
    cleaned = F.coalesce(own("_new"), text)
    return docs.join(new, same, "left").select(*[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in names], F.coalesce(number, F.lit(0)).cast("bigint").alias(number))
