"""Replace personal data by keyed surrogates of the same kind, gender, script and format; DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunehouse.llm.common import fields, landed, remove, whole_row

KEY_SETTING = "spark.tunehouse.pii.key"  # where a session keeps the owner's secret
KEY = "tunehouse"  # stands for it where none is set, as in tests; whoever knows the key can test guesses
STUCK_ROUNDS = 64  # rounds in a row without a single new surrogate, after which there is no room left

# fixed values: titles and common given names, by gender; name parts by script
TITLES = {
    "f": "Mrs Ms Miss Frau Fräulein Madame Mme Mlle Señora Señorita Signora г-жа госпожа",
    "m": "Mr Mister Herr Monsieur Señor Signor г-н господин",
    "u": "Dr Prof",
}
GIVEN = {
    "f": "Mary Patricia Jennifer Linda Elizabeth Susan Jessica Sarah Emily Emma Olivia Sophie Marie Claire Camille Anna Julia Katharina Sabine Monika Lucía María Carmen Isabel Ann Anne Barbara Margaret Nancy Laura Alice Helen Ruth Grace Chloe Hannah Rachel Rebecca Charlotte Ingrid Greta Petra Giulia Francesca Chiara Sofia Elena Ines Beatriz Ana Priya Ananya Aisha Fatima Leila Yuki Sakura Mei Xiu Yan Ngozi Amina Анна Мария Елена Ольга Наталья Ирина",
    "m": "James John Robert Michael William David Richard Thomas Charles Daniel Pierre Jean Jacques Louis Hans Peter Klaus Stefan Jürgen José Carlos Juan Miguel Pablo George Joseph Paul Mark Steven Andrew Kevin Brian Edward Henry Frank Walter Ludwig Wolfgang Johann Friedrich Otto Karl Lars Erik Sven Nikolai Marco Luca Giovanni Antonio Francisco Diego Javier Ahmed Mohammed Omar Hassan Raj Arjun Vikram Sanjay Wei Hiroshi Kenji Takashi Kwame Иван Александр Сергей Дмитрий Алексей Михаил",
}
SYLLABLES = {
    "latin": "ba be bo da de do ka ke la le lo ma mi na ra ro".split(),
    "cyrillic": "ба бе бо да де до ка ке ла ле ло ма ми на ра ро".split(),
    "greek": "βα βε βο δα δε δο κα κε λα λε λο μα μι να ρα ρο".split(),
}
ENDINGS = {
    ("given_f", "latin"): "na lia ra sa".split(),
    ("given_m", "latin"): "n ron s to".split(),
    ("given_u", "latin"): "l ri x y".split(),
    ("surname", "latin"): "berg man son ton".split(),
    ("given_f", "cyrillic"): "на лия ра ся".split(),
    ("given_m", "cyrillic"): "н рон с тор".split(),
    ("given_u", "cyrillic"): "л ри кс ль".split(),
    ("surname", "cyrillic"): "ов ин ский енко".split(),
    ("given_f", "greek"): "να λια ρα σα".split(),
    ("given_m", "greek"): "νος ρος σης τος".split(),
    ("given_u", "greek"): "λ ρι ξ ψ".split(),
    ("surname", "greek"): "ιδης ακης ου οπουλος".split(),
}


def _any(words: str) -> str:
    """The words as a pattern, as written and in capitals, long ones first, grouped by their first letter."""
    by_first: dict[str, set[str]] = {}
    for word in {*words.split(), *words.upper().split()}:
        by_first.setdefault(word[0], set()).add(word[1:])
    return "|".join(f"{c}(?:{'|'.join(sorted(rest, key=lambda w: (-len(w), w)))})" for c, rest in sorted(by_first.items()))


TITLE = _any(" ".join(TITLES.values()))
NAME = r"\p{Lu}(?:\p{Ll}++|\p{Lu}++)(?:[-'’](?![sS](?!\p{L}))\p{L}++){0,3}+"  # without a genitive's s
PARTICLES = "van von der den de del della di da dos du la le bin ibn al el zu zur ter ten af av"  # fixed value
SPACE = r"[ \u00a0]{1,3}+"
LINE_BREAK = r"[ \u00a0]{0,2}+\r?\n[ \u00a0\t]{0,8}+"  # a name may go on in the next line after a title or first name
# what may stand before the last word of a name: initials, particles and more names
MIDDLE = rf"(?:(?:\p{{Lu}}\.|(?:{PARTICLES.replace(' ', '|')})|{NAME}){SPACE}){{0,4}}"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
HEX_GROUP = "[0-9A-Fa-f]{1,4}"
GIVEN_NAME = _any(" ".join(GIVEN.values()))
INITIALS = "".join(sorted({w[0] for w in " ".join([*TITLES.values(), *GIVEN.values()]).split()}))
# in the order in which they are tried; separators are such that neighbouring numbers are not drawn in; what repeats without
# bound is possessive, as the engine else goes a call deeper for every repeat
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "iban": r"(?=[A-Z]{2}\d)(?<!\w)(?:[A-Z]{2}\d{2}(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?|[A-Z]{2}\d{2}[A-Z0-9]{11,30})(?!\w)",
    "phone": r"(?=[+(\d])(?:(?<![\w+])\+\d{1,3}[ .-]?\(\d{1,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d|[.-]\d)"
    r"|(?<![\w(.-])(?:\(\d{3}\) ?|\d{3}[-.])\d{3}[-.]\d{4}(?!\d|[.-]\d)"
    r"|(?<![\w(.-])(?<!\d )(?:\d{3} \d{3} \d{4}|0\d{1,4} \d{3,4} \d{3,4})(?!\w|[ .-]\d))",
    "card": r"(?=\d)(?<![\w.])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w|\.\d)",
    "ssn": r"(?=\d)(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": rf"(?=\d)(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w|\.\d)",
    "ip6": rf"(?=[0-9A-Fa-f:]{{0,4}}:)(?=[A-Fa-f:]*+\d)(?<![\w:.])(?:(?:{HEX_GROUP}:){{7}}{HEX_GROUP}"
    rf"|(?:{HEX_GROUP}:){{1,7}}:(?:{HEX_GROUP}(?::{HEX_GROUP}){{0,6}})?|::{HEX_GROUP}(?::{HEX_GROUP}){{0,6}})(?![\w:])",
    "person": rf"(?=[{INITIALS}])(?<![\p{{L}}\p{{N}}])(?:(?:(?:{TITLE})\.?(?:{SPACE}|{LINE_BREAK})){{1,2}}{MIDDLE}{NAME}"
    rf"|(?:{GIVEN_NAME})(?:[-'’]\p{{L}}++){{0,2}}+(?:{SPACE}|{LINE_BREAK}){MIDDLE}{NAME})(?![\p{{L}}\p{{N}}])",
}
# every kind starts where no letter or digit comes before, so most places are passed over at once
PATTERN = rf"(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(PATTERNS.values())})"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def session_key(spark: SparkSession) -> str:
    """The owner's secret of a session, set before under ``KEY_SETTING``."""
    return spark.conf.get(KEY_SETTING, KEY)


def has_personal_data(text: Column) -> Column:
    return F.coalesce(text.rlike(PATTERN), F.lit(False))


def kind_of(entity: Column) -> Column:
    """The kind whose pattern matches the whole entity."""
    kinds = F.lit("person")
    for kind in reversed([k for k in PATTERNS if k != "person"]):
        kinds = F.when(entity.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(kinds)
    return kinds


def script_of(name: Column) -> Column:
    cyrillic, greek = name.rlike(r"\p{IsCyrillic}"), name.rlike(r"\p{IsGreek}")
    return F.when(cyrillic, F.lit("cyrillic")).when(greek, F.lit("greek")).otherwise(F.lit("latin"))


def _is_title(word: Column) -> Column:
    return word.rlike(rf"^(?:{TITLE})\.?$")


def name_tokens(entity: Column) -> Column:
    """The words of a person's name as (word, kind, norm); kind is NULL for titles, initials and particles.

    The last word is a surname. Of the words before it those in the lists of given names and the first one are given
    names, whose gender comes from the name (of a hyphenated one, its first part) or else from the title; the others
    are surnames too. Names are mapped word by word, so that "Mr. John Smith", "Mr. Smith" and "Smith" keep one surname.
    """
    words = F.split(entity, r"\s+|\u00a0+")
    women, men = (entity.rlike(rf"(?:^|[\s\u00a0])(?:{_any(TITLES[g])})\.?[\s\u00a0]") for g in "fm")
    kept = lambda w: _is_title(w) | w.rlike(rf"^(?:\p{{Lu}}\.|{PARTICLES.replace(' ', '|')})$")
    first = F.array_position(F.transform(words, kept), False) - 1

    def token(word: Column, at: Column) -> Column:
        norm = F.lower(word)
        head = F.regexp_extract(norm, r"^[^-'’]*", 0)
        given_f = head.isin([w.lower() for w in GIVEN["f"].split()])
        given_m = head.isin([w.lower() for w in GIVEN["m"].split()])
        gender = F.when(given_f, "given_f").when(given_m, "given_m").when(women, "given_f").when(men, "given_m").otherwise("given_u")
        last = at == F.size(words) - 1
        role = F.when(~last & (given_f | given_m | (at == first)), gender).otherwise(F.lit("surname"))
        kind = F.when(~kept(word) | last, F.concat_ws("_", role, script_of(word)))
        return F.struct(word.alias("word"), kind.alias("kind"), norm.alias("norm"))

    return F.transform(words, token)


def norm_of(kind: Column, entity: Column) -> Column:
    """What counts as the same entity: letters and digits of a number, the address in lower case."""
    bare = F.regexp_replace(entity, "[^0-9A-Za-z]", "")
    return F.when(kind.isin("email", "ip6"), F.lower(entity)).when(kind == "ip", entity).otherwise(bare)


def entity_tokens(entity: Column) -> Column:
    """(kind, norm) of all that is replaced in an entity."""
    kind = kind_of(entity)
    one = F.array(F.struct(kind.alias("kind"), norm_of(kind, entity).alias("norm")))
    names = F.filter(name_tokens(entity), lambda t: t["kind"].isNotNull())
    names = F.transform(names, lambda t: F.struct(t["kind"].alias("kind"), t["norm"].alias("norm")))
    return F.when(kind == "person", names).otherwise(one)


# ---- surrogates


def _byte(digest: Column, i: Column) -> Column:
    """The i-th byte (from 1) of a hexadecimal digest of 128 bytes; further bytes start anew."""
    at = (F.pmod(i - 1, F.lit(128)) * 2 + 1).cast("int")
    return F.conv(F.substring(digest, at, F.lit(2)), 16, 10).cast("int")


def _chars(text: Column, change) -> Column:
    """Apply change(character, place from 1) to each character."""
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: change(c, i + 1)), "")


def _alike(text: Column, digest: Column) -> Column:
    """A digit for a digit, a letter for a letter, all else as it is."""

    def change(c: Column, i: Column) -> Column:
        b = _byte(digest, i)
        digit = (b % 10).cast("string")
        lower, upper = (F.substring(F.lit(x), b % 26 + 1, F.lit(1)) for x in (LOWER, UPPER))
        return F.when(c.rlike("[0-9]"), digit).when(c.rlike(r"\p{Lu}"), upper).when(c.rlike(r"\p{L}"), lower).otherwise(c)

    return _chars(text, change)


def _hex_alike(text: Column, digest: Column) -> Column:
    """A hexadecimal digit for each, colons as they are; a group never begins with a zero, so that it has one spelling."""

    def change(c: Column, i: Column) -> Column:
        return F.when(c == ":", c).otherwise(F.substring(F.lit("123456789abcdef"), _byte(digest, i) % 15 + 1, F.lit(1)))

    return _chars(text, change)


def luhn_rest(digits: Column) -> Column:
    """The weighted digit sum modulo 10 that card numbers use; 0 for a valid number."""

    def weighted(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (F.length(digits) - i) % 2 == 1
        return F.when(twice, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    places = F.transform(F.sequence(F.lit(1), F.length(digits)), weighted)
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10


def _iban_rest(text: Column) -> Column:
    """The number modulo 97 of an account number whose letters count from 10."""
    chars = F.split(text, "")

    def add(rest: Column, c: Column) -> Column:
        letter = c.rlike("[A-Z]")
        step = F.when(letter, rest * 100 + F.ascii(c) - 55).otherwise(rest * 10 + F.when(c.rlike("[0-9]"), c).otherwise("0").cast("int"))
        return F.when(c == "", rest).otherwise(step % 97)

    return F.aggregate(chars, F.lit(0), add)


def _name(kind: Column, digest: Column, attempt: Column) -> Column:
    """A made-up name of the script, with an ending of the gender; longer with every second attempt, so there are always more."""
    made = F.lit(None).cast("string")
    for (role, script), endings in ENDINGS.items():
        table = F.array(*map(F.lit, SYLLABLES[script]))
        body = F.transform(F.sequence(F.lit(1), F.lit(3) + F.floor(attempt / 2).cast("int")), _pick(table, digest))
        ending = F.element_at(F.array(*map(F.lit, endings)), _byte(digest, F.lit(100)) % len(endings) + 1)
        made = F.when(kind == f"{role}_{script}", F.concat(F.array_join(body, ""), ending)).otherwise(made)
    return made


def _pick(table: Column, digest: Column):
    return lambda i: F.element_at(table, _byte(digest, i) % F.size(table) + 1)


def surrogate(kind: Column, norm: Column, attempt: Column, key: str = KEY) -> Column:
    """The replacement of an entity, in the same normal form.

    e-mail: length and separators stay, the last label is the reserved "example"; phone: the first digit stays;
    card: the first digit stays, and a valid check digit stays valid, a wrong one wrong; account: the country
    stays, with valid check digits; address: another address; name: a name of the gender and script.
    """
    seed = F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string"))
    digest = F.concat(F.sha2(seed, 512), F.sha2(F.concat(seed, F.lit("+")), 512))
    # a variable of one value, so that the digest is not computed anew for every character
    return F.transform(F.array(digest), lambda d: _surrogate_from(d, kind, norm, attempt))[0]


def _surrogate_from(digest: Column, kind: Column, norm: Column, attempt: Column) -> Column:
    alike = _alike(norm, digest)
    longer = F.concat(F.repeat(F.lit("x"), F.floor(attempt / 4).cast("int")), norm)
    email = F.regexp_replace(_alike(longer, digest), r"(?<![^.@])[^.@]++$", "example")
    first = F.substring(norm, F.lit(1), F.lit(1))
    phone = F.concat(first, F.substring(alike, F.lit(2), F.length(norm)))
    open_card = F.concat(first, F.substring(alike, F.lit(2), F.length(norm) - 2))
    last = F.pmod(luhn_rest(norm) - luhn_rest(F.concat(open_card, F.lit("0"))), F.lit(10))
    card = F.concat(open_card, last.cast("string"))
    country, account = F.substring(norm, 1, 2), F.substring(alike, F.lit(5), F.length(norm))
    check = F.lit(98) - F.pmod(_iban_rest(F.concat(account, country, F.lit("00"))), F.lit(97))
    iban = F.concat(country, F.lpad(check.cast("string"), 2, "0"), account)
    octets = [_byte(digest, F.lit(1)) % 223 + 1, *(_byte(digest, F.lit(i)) for i in (2, 3, 4))]
    ip = F.concat_ws(".", *[o.cast("string") for o in octets])
    made = {"email": email, "phone": phone, "card": card, "iban": iban, "ip": ip, "ip6": _hex_alike(norm, digest), "ssn": alike}
    return reduce(lambda rest, k: F.when(kind == k, made[k]).otherwise(rest), made, _name(kind, digest, attempt))


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """Distinct (kind, norm) -> with surrogate, stored: no two entities of a kind share one, and none is an entity itself.

    A surrogate depends on key, kind and entity alone unless it collides. Of those that collide the earliest
    attempt keeps it (of equal ones the smallest entity); the others try again, until none collides. As long as there
    is room some of them find it, so only many rounds in a row without one end in an error.
    """
    spark = entities.sparkSession

    def tried(df: DataFrame) -> DataFrame:
        return df.withColumn("surrogate", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key))

    state, path = landed(tried(entities.withColumn("attempt", F.lit(0))), "surrogates")
    least, stuck = None, 0
    while True:
        rank = F.struct("attempt", "norm")
        first = state.groupBy("kind", "surrogate").agg(F.min(rank).alias("first"))
        real = state.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("real"))
        judged = state.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        lost = (rank != F.col("first")) | F.coalesce("real", F.lit(False))
        verdict, verdict_path = landed(judged.select("kind", "norm", "attempt", "surrogate", lost.alias("lost")), "surrogate-rounds")
        again = verdict.where("lost")
        left = again.count()
        if not left:
            remove(spark, verdict_path)
            return state.select("kind", "norm", "surrogate")
        stuck = 0 if least is None or left < least else stuck + 1
        least = left if least is None else min(least, left)
        if stuck == STUCK_ROUNDS:
            kinds = ", ".join(r["kind"] for r in again.select("kind").distinct().orderBy("kind").collect())
            raise RuntimeError(f"more entities than there are surrogates of their format: {kinds}")
        settled = verdict.where("not lost").select(*state.columns)
        retried = tried(again.select("kind", "norm", (F.col("attempt") + 1).alias("attempt"))).select(*state.columns)
        state, newer = landed(settled.unionByName(retried), "surrogates")
        remove(spark, path)
        remove(spark, verdict_path)
        path = newer


# ---- texts


def _laid_out(entity: Column, made: Column) -> Column:
    """The letters and digits of a surrogate in the places of the entity's own, separators as they are."""

    def change(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substring(entity, F.lit(1), i), "[^0-9A-Za-z]", ""))
        return F.when(c.rlike("[0-9A-Za-z]"), F.substring(made, place, F.lit(1))).otherwise(c)

    return _chars(entity, change)


def cased(word: Column, made: Column) -> Column:
    """A name in capitals, or with a first capital, as the word it replaces."""
    return F.when((F.upper(word) == word) & (F.length(word) > 1), F.upper(made)).otherwise(F.initcap(made))


def render(entity: Column, names: Column) -> Column:
    """The replacement of an entity in its own layout and case; ``names`` maps "kind:norm" to a surrogate."""
    kind = kind_of(entity)

    def found(kind: Column, norm: Column) -> Column:
        return F.element_at(names, F.concat_ws(":", kind, norm))

    def named(t: Column) -> Column:
        return F.when(t["kind"].isNull(), t["word"]).otherwise(cased(t["word"], found(t["kind"], t["norm"])))

    gaps = F.array_append(F.regexp_extract_all(entity, F.lit(r"[\s\u00a0]+"), F.lit(0)), F.lit(""))
    person = F.array_join(F.zip_with(F.transform(name_tokens(entity), named), gaps, lambda n, g: F.concat(n, g)), "")
    own = found(kind, norm_of(kind, entity))
    email = F.when((F.upper(entity) == entity), F.upper(own)).otherwise(own)
    upper6 = F.when(F.upper(entity) == entity, F.upper(own)).otherwise(own)
    return F.when(kind == "person", person).when(kind == "email", email).when(kind == "ip", own).when(kind == "ip6", upper6).otherwise(_laid_out(entity, own))


def bare_surnames(text: Column, names: Column) -> Column:
    """What stands between the entities, with the surnames of the document's persons replaced where they stand alone.

    Only whole words count that are written like a name; ``names`` is the map that ``render`` takes.
    """

    def word(piece: Column) -> Column:
        bare, genitive = F.regexp_replace(piece, "['’][sS]$", ""), F.regexp_extract(piece, "(['’][sS])?$", 0)
        made = F.element_at(names, F.concat(F.lit("surname_"), script_of(bare), F.lit(":"), F.lower(bare)))
        return F.when(piece.rlike(r"^\p{Lu}"), F.coalesce(F.concat(cased(bare, made), genitive), piece)).otherwise(piece)

    edges = r"(?<![\p{L}\p{N}'’-])(?=\p{Lu})|(?<=[\p{L}\p{N}])(?![\p{L}\p{N}'’-])"
    has_some = F.exists(F.map_keys(names), lambda k: k.startswith("surname_"))
    return F.when(has_some, F.array_join(F.transform(F.split(text, edges, -1), word), "")).otherwise(text)


def _replaced(docs: DataFrame, key: str) -> DataFrame:
    """(row, new, n_entities) per row of ``docs``: all its columns as a struct, its text with surrogates.

    An entity has one surrogate everywhere, in its own layout each time, and two entities never share one. Only
    documents with an entity are stored, shuffled and rewritten, by a row number of their own, so NULL ids and
    repeated rows do not matter; the others pass as they are. A document's entities are gathered per document,
    which its text bounds; a frequent entity is a plain join, which adaptive execution can split. NULL and empty
    texts stay as they are.
    """
    text = F.col("text").cast("string")
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    # the number also keeps the filter behind the extraction, so that each text is searched once here
    some = docs.select(whole_row(docs).alias("row"), text.alias("text"), F.monotonically_increasing_id().alias("number"), found.alias("found"))
    hits = landed(some.where(F.size("found") > 0), "personal")[0]
    tokens = hits.select("number", F.explode(F.array_distinct("found")).alias("entity"))
    tokens = tokens.select("number", F.explode(entity_tokens(F.col("entity"))).alias("t")).select("number", "t.kind", "t.norm").distinct()
    tokens = landed(tokens, "personal-tokens")[0]
    # few bytes, but much work each: the number of partitions is not left to their size
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = assign(tokens.select("kind", "norm").repartition(partitions, "kind", "norm").distinct(), key)
    pair = F.struct(F.concat_ws(":", "kind", "norm"), F.col("surrogate"))
    names = tokens.join(known, ["kind", "norm"]).groupBy("number").agg(F.map_from_entries(F.collect_list(pair)).alias("names"))
    rows = hits.join(names, "number", "left")
    made = F.transform("found", lambda e: render(e, F.col("names")))
    gaps = F.transform(F.split("text", PATTERN, -1), lambda g: bare_surnames(g, F.col("names")))
    pieces = F.zip_with(gaps, made, lambda g, m: F.concat(g, F.coalesce(m, F.lit(""))))
    rewritten = rows.select("row", F.array_join(pieces, "").alias("new"), F.size("found").alias("n_entities"))
    others = docs.where(~has_personal_data(text)).select(whole_row(docs).alias("row"), text.alias("new"), F.lit(0).alias("n_entities"))
    return others.unionByName(rewritten)


def replace_personal_data(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with every detected entity of ``text`` replaced; other columns stay, n_chars follows a changed text."""
    changed = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        own = F.col("row.n_chars")
        changed["n_chars"] = F.when(F.col("n_entities") > 0, F.length("new").cast(docs.schema["n_chars"].dataType)).otherwise(own)
    return _replaced(docs, key).select(*fields(docs, "row", **changed))


def surrogate_texts(docs: DataFrame, key: str = KEY) -> DataFrame:
    """Per row: doc_id, text with surrogates, n_entities (of the original text)."""
    replaced = _replaced(docs.select("doc_id", "text"), key)
    return replaced.select("row.doc_id", F.col("new").alias("text"), F.col("n_entities").cast("bigint").alias("n_entities"))
