import re

import pytest
from pyspark.sql import functions as F

from tunehouse.llm import pii

TEXT = (
    "Mr. John Smith met Mrs. Anna Weber-Lang and Mr. Smith; MR. JOHN SMITH! г-жа Анна Петрова, "
    "john.smith@mail.example.com JOHN.SMITH@MAIL.EXAMPLE.COM +1 (535) 555-5412 169.1.1.1 4111111111111111 "
    "4111 1111 1111 1111 4111111111111112 DE89 3704 0044 0532 0130 00 123-45-6789"
)
NUMBERS = {"email": r"[\w.%+-]+@[\w.-]+\w", "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])", "long": r"\d{13,}"}


def run(spark, texts, key=pii.KEY):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    rows = {r["doc_id"]: r for r in pii.surrogate_texts(docs, key).collect()}
    return [rows[i]["text"] for i in range(len(texts))], [rows[i]["n_entities"] for i in range(len(texts))]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def iban_ok(text):
    bare = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


@pytest.fixture(scope="module")
def replaced(spark):
    texts, counts = run(spark, [TEXT, "again JOHN SMITH and john.smith@mail.example.com", None, ""])
    assert counts == [14, 2, 0, 0]
    return texts


def test_same_entity_same_surrogate(replaced):
    one = replaced[0]
    names = re.match(r"Mr\. (\S+) (\S+) met Mrs\. (\S+) (\S+) and Mr\. (\S+); MR\. (\S+) (\S+)! г-жа (\S+) (\S+),", one).groups()
    john, smith, anna, weber, smith2, john2, smith3, anna_c, petrova = names
    assert smith == smith2 and (john2, smith3) == (john.upper(), smith.upper())
    assert len({john, smith, anna, weber, anna_c, petrova, "John", "Smith", "Anna", "Weber-Lang", "Анна", "Петрова"}) == 12
    mail, loud = re.findall(NUMBERS["email"], one)
    assert loud == mail.upper() and mail.endswith(".example") and mail != "john.smith@mail.example.com"
    assert mail in replaced[1]
    assert replaced[2] is None and replaced[3] == ""


def test_gender_script_and_format(replaced):
    one = replaced[0]
    john, anna = re.search(r"Mr\. (\S+) ", one)[1], re.search(r"Mrs\. (\S+) ", one)[1]
    assert any(john.endswith(e) for e in pii.ENDINGS["given_m", "latin"])
    assert any(anna.endswith(e) for e in pii.ENDINGS["given_f", "latin"])
    given = re.search(r"г-жа (\S+) (\S+),", one)
    assert re.fullmatch(r"[А-Яа-я]+", given[1]) and any(given[1].endswith(e) for e in pii.ENDINGS["given_f", "cyrillic"])
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4} ", one)
    card = re.findall(r"(?<!\d)4\d{15}(?!\d)", one)
    spaced = re.search(r"(?<!\d)4\d{3} \d{4} \d{4} \d{4}", one)[0]
    assert spaced.replace(" ", "") == card[0] and luhn(card[0]) == 0 and luhn(card[1]) == luhn("4111111111111112") != 0
    assert iban_ok(re.search(r"DE\d\d(?: \w{4}){4} \w\w", one)[0])
    assert all(int(x) < 256 for x in re.search(NUMBERS["ip"], one)[0].split("."))
    for old in ("Smith", "Weber", "Петрова", "john.smith", "555-5412", "169.1.1.1", "4111", "0532", "123-45"):
        assert old.lower() not in one.lower()


def test_all_else_stays(replaced):
    shape = re.sub(r"\S*\d\S*|\S+@\S+", "#", replaced[0])
    assert shape.count(" ") == TEXT.count(" ") and " met Mrs. " in shape and "; MR. " in shape


def test_key_changes_surrogates(spark, replaced):
    other, _ = run(spark, [TEXT], key="another")
    assert other[0] != replaced[0]
    assert run(spark, [TEXT])[0][0] == replaced[0]


def test_neighbouring_numbers_are_kept_apart(spark):
    texts = ["4952935900253052 4225039295678253", "+1 (535) 555-5412 169.122.221.182", "4952935900253052 169.122.221.182", "+44 20 7946 0958 169.122.221.182"]
    new, counts = run(spark, texts)
    assert counts == [2, 2, 2, 2]
    for old, t in zip(texts, new, strict=True):
        assert [len(x) for x in t.split()[:1]] == [len(x) for x in old.split()[:1]] and not set(re.findall(r"\d{4,}", old)) & set(re.findall(r"\d{4,}", t))
    assert all(re.search(NUMBERS["ip"], t) for t in new[1:])


def test_what_is_no_personal_data_stays(spark):
    texts = ["Version 2.0. of 2024-01-01, 1.2.3 and 12345678", "token = 0123456789abcdef0123456789abcdef01234567", "a@b", "Don Quixote? don. Esta", "300.1.1.1", "Ms and Mr of it"]
    new, counts = run(spark, texts)
    assert new == texts and counts == [0] * len(texts)


def test_distinct_entities_stay_distinct(spark):
    """More entities than a first draw keeps apart: all four-letter surnames collide again and again."""
    names = [f"{a}{b}{c}" for a in "BCDFGHJKLM" for b in ("ar", "el", "im", "on", "us") for c in ("ba", "co", "di", "fe", "gu", "ha", "ki", "lo", "mu", "ne", "po", "ri", "su", "ta", "vo", "wi", "xa", "ye", "zu", "ob", "ed", "if", "ug", "an", "ol")]
    entities = spark.createDataFrame([("surname_latin", n.lower()) for n in names], "kind string, norm string")
    rows = pii.assign(entities).collect()
    assert len(rows) == len(names) == len({r["surrogate"] for r in rows})
    assert not {r["surrogate"] for r in rows} & {n.lower() for n in names}


def test_collisions_are_resolved(spark, monkeypatch):
    """A surrogate with room for 30 values: 20 entities still get 20 of them, none an entity itself."""
    def narrow(kind, norm, attempt, key=pii.KEY):
        return F.pmod(F.xxhash64(kind, norm, attempt), F.lit(40)).cast("string")

    monkeypatch.setattr(pii, "surrogate", narrow)
    rows = pii.assign(spark.createDataFrame([("ip", str(i)) for i in range(15)], "kind string, norm string")).collect()
    assert len({r["surrogate"] for r in rows}) == 15 and not {r["surrogate"] for r in rows} & {r["norm"] for r in rows}
    with pytest.raises(RuntimeError):
        monkeypatch.setattr(pii, "STUCK_ROUNDS", 4)
        pii.assign(spark.createDataFrame([("ip", str(i)) for i in range(30)], "kind string, norm string"))


def test_awkward_rows(awkward, nothing):
    out = pii.replace_personal_data(awkward)
    assert out.dtypes == awkward.dtypes
    before, after = ({(r["doc_id"], r["text"]) for r in d.collect()} for d in (awkward, out))
    assert out.count() == awkward.count()
    (new,) = after - before
    (old,) = before - after
    assert new[0] == old[0] == 11 and "a.b@" not in new[1] and new[1].endswith("\nReleased under the MIT License.")
    assert out.where("doc_id = 11").first()["n_chars"] == len(new[1])
    assert pii.replace_personal_data(nothing).count() == 0


def test_no_planted_entity_is_left(spark, con, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = 0
    for r in pii.surrogate_texts(docs).collect():
        old = [m for p in NUMBERS.values() for m in re.findall(p, texts[r["doc_id"]]) if re.fullmatch(p, m)]
        old = [m for m in old if not re.search(r"[0-9a-f]{20}", texts[r["doc_id"]]) or "@" in m]
        found += len(old)
        assert not [m for m in old if m in r["text"]]
        assert (r["n_entities"] > 0) == (r["text"] != texts[r["doc_id"]])
    assert found


LEFT = {
    "Mary Ann Smith": ["Mary", "Ann", "Smith"],
    "Mr. John Michael Smith": ["John", "Michael", "Smith"],
    "Dr. Ludwig van Beethoven": ["Ludwig", "Beethoven"],
    "Jean-Pierre Dupont": ["Jean", "Pierre", "Dupont"],
    "John Q. Public": ["John", "Public"],
    "Mary  Smith": ["Mary", "Smith"],
    "Mary\nSmith": ["Mary", "Smith"],
    "Mrs.\n  Anna Weber": ["Anna", "Weber"],
    "Wei Zhang and Priya Natarajan": ["Wei", "Zhang", "Priya", "Natarajan"],
    "call 555 123 4567 now": ["555", "4567"],
    "call 020 7946 0958 now": ["7946", "0958"],
    "at 2001:db8::1 or fe80::1ff:fe23:4567:890a": ["2001", "db8", "fe80", "4567"],
    "2001:0DB8:0000:0000:0000:FF00:0042:8329": ["0DB8", "FF00"],
    "Mr. Smith's hat. Smith left; SMITH'S hat, Smithson stayed.": ["Smith ", "Smith'", "SMITH"],
}


def test_nothing_of_an_entity_is_left(spark):
    texts, counts = run(spark, list(LEFT))
    for before, after, n in zip(LEFT, texts, counts, strict=True):
        assert n >= 1 and not [x for x in LEFT[before] if re.search(rf"(?<!\w){re.escape(x)}", after)], after
    found = re.fullmatch(r"Mr\. (\w+)'s hat\. \1 left; (\w+)'S hat, Smithson stayed\.", texts[-1])
    assert found[1].upper() == found[2]
    assert re.fullmatch(r"\w+ Q\. \w+", texts[4]) and re.fullmatch(r"\w+  \w+", texts[5]) and re.fullmatch(r"\w+\n\w+", texts[6])
    assert " van " in texts[2] and re.fullmatch(r"call \d{3} \d{3} \d{4} now", texts[9])


CLEAN = [
    "Prices were 100 200 300 and 12:30:45 on 2024-01-02; std::vector, a::b, version 1.2.3.4.5, item 12345.",
    "The Smith of the village. Ann went home. mary smith. Mr. said nothing. 1234 567 8901 23",
    "x:1:2:3 and ::: and 10::20 is not hex:here",
]


def test_clean_texts_stay(spark):
    texts, counts = run(spark, CLEAN)
    assert texts[:2] == CLEAN[:2] and counts[:2] == [0, 0]


def plain_pattern():
    """The kinds' patterns for another engine."""
    import regex

    pattern = pii.PATTERN.replace(r"\p{Lu}", r"\p{Uppercase_Letter}").replace(r"\p{Ll}", r"\p{Lowercase_Letter}")
    return regex.compile(pattern)


def plain_replaced(text, after, seen, words):
    """Check ``after`` against a replacement made one entity at a time: what is no entity stays letter by letter, what is
    one goes, and equal words get equal surrogates. ``seen`` and ``words`` collect entity -> surrogate over all texts."""
    import regex

    gaps, entities, at = [], [], 0
    for m in plain_pattern().finditer(text):
        gaps.append(text[at : m.start()])
        entities.append(m[0])
        at = m.end()
    gaps.append(text[at:])
    surnames = {w.lower() for e in entities if not regex.search(r"[\d@]", e) for w in regex.split(r"\s+", e)}
    parts = [regex.escape(g) for g in gaps]
    for i, g in enumerate(gaps):
        pieces = regex.split(r"(?V1)(?<![\p{L}\p{N}'’-])(?=\p{Lu})|(?<=[\p{L}\p{N}])(?![\p{L}\p{N}'’-])", g)
        known = lambda x: regex.match(r"\p{Lu}", x) and regex.sub("['’][sS]$", "", x).lower() in surnames
        parts[i] = "".join(r"[\p{L}'’-]+" if known(x) else regex.escape(x) for x in pieces)
    m = regex.fullmatch("(.+?)".join(f"(?:{p})" for p in parts), after, regex.DOTALL)
    assert m, (text, after)
    for entity, made in zip(entities, m.groups(), strict=True):
        assert entity != made
        if regex.search(r"[\d@]", entity):
            assert seen.setdefault(entity, made) == made
        else:
            for a, b in zip(regex.split(r"\s+", entity), regex.split(r"\s+", made), strict=True):
                words.setdefault(a.lower(), set()).add(b.lower())
    return len(entities)


def test_every_document_against_a_plain_replacer(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    seen, words, total = {}, {}, 0
    for r in pii.surrogate_texts(docs).collect():
        n = plain_replaced(before[r["doc_id"]], r["text"], seen, words)
        assert n == r["n_entities"]
        total += n
    assert total > 20
    # no two entities share a surrogate, and none is an entity itself
    bare = {re.sub(r"[^\w@.:]", "", k).lower(): re.sub(r"[^\w@.:]", "", v).lower() for k, v in seen.items()}
    assert len(set(bare.values())) == len(bare) and not set(bare.values()) & set(bare)
    assert all(len(v) <= 2 for v in words.values())


def test_room_is_used_up_to_the_end(spark, monkeypatch):
    """Ten digits of which most are taken: rounds go on as long as one of them finds a place."""
    monkeypatch.setattr(pii, "surrogate", lambda kind, norm, attempt, key: F.pmod(F.xxhash64("norm", "attempt"), F.lit(40)).cast("string"))
    entities = spark.createDataFrame([("ssn", str(i)) for i in range(18)], "kind string, norm string")
    rows = pii.assign(entities).collect()
    assert len({r["surrogate"] for r in rows}) == 18 and not {r["surrogate"] for r in rows} & {str(i) for i in range(18)}


def test_the_key_comes_from_the_session(spark):
    assert pii.session_key(spark) == pii.KEY
    spark.conf.set(pii.KEY_SETTING, "other")
    try:
        assert pii.session_key(spark) == "other"
    finally:
        spark.conf.unset(pii.KEY_SETTING)
