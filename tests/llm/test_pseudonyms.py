import hashlib
import re
from datetime import date, timedelta

import brute
import pytest
from pyspark.sql import functions as F

from labelloom.llm import pseudonyms as p

KEY = "k"


def permuted(digits, radices, tweak, key=KEY):
    """The network once more, in plain Python."""
    half = len(digits) // 2
    sides, rad = [list(digits[:half]), list(digits[half:])], [radices[:half], radices[half:]]
    for i in range(p.ROUNDS):
        moving, fixed = i % 2, 1 - i % 2
        h = hashlib.sha512(f"{key}|{tweak}|{len(digits)}|{i}|{','.join(map(str, sides[fixed]))}".encode()).hexdigest()
        sides[moving] = [
            (d + int(h[at % 32 * 4 : at % 32 * 4 + 4], 16)) % m for at, (d, m) in enumerate(zip(sides[moving], rad[moving]))
        ]
    return sides[0] + sides[1]


@pytest.fixture
def replaced(docs_of):
    def run(*texts, key=KEY):
        rows = p.report(docs_of(list(enumerate(texts))), key).orderBy("doc_id").collect()
        return [(r.text, r.found, r.new) for r in rows]

    return run


def test_cards_stay_valid_and_linked_however_they_are_written(replaced):
    (text, found, new), = replaced("pay 4111 1111 1111 1111, 4111-1111-1111-1111 or 4111111111111111; not 4111111111111112")
    digits = [re.sub(r"\D", "", v) for v in new]
    assert len(found) == 4 and digits[0] == digits[1] == digits[2] != "4111111111111111"
    assert brute.luhn(digits[0]) and digits[3] == "4111111111111112"
    assert [int(c) for c in digits[0][:15]] == permuted([4] + [1] * 14, [10] * 15, "card")
    assert re.fullmatch(r"pay \d{4} \d{4} \d{4} \d{4}, \d{4}-\d{4}-\d{4}-\d{4} or \d{16}; not 4111111111111112", text)


def test_dates_are_permuted_within_their_block(spark):
    first = date(1985, 1, 1)
    days = [(first + timedelta(i)).isoformat() for i in range(p.BLOCK_DAYS)]
    frame = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d"), p.pseudonym(F.col("d"), KEY).alias("n"))
    rows = {r.d: r.n for r in frame.collect()}
    assert sorted(rows.values()) == days
    at = permuted([5000 // 487, 5000 % 487], [21, 487], "date")
    assert rows[days[5000]] == days[at[0] * 487 + at[1]]


def test_one_date_in_several_forms(replaced):
    (_, _, (iso, dotted, us, short)), = replaced("1999-12-31 31.12.1999 12/31/1999 1/2/2003")
    y, m, d = iso.split("-")
    assert dotted == f"{d}.{m}.{y}" and us == f"{m}/{d}/{y}" and iso != "1999-12-31"
    assert re.fullmatch(r"\d{1,2}/\d{1,2}/\d{4}", short)
    for text in ("2023-02-30", "1850-01-01", "2023-13-01"):
        assert replaced(text)[0][0] == text


def test_addresses_phones_and_numbers(replaced):
    texts = [
        "Jo.Doe+x9@example.com", "née.öß.77@mail3.example.com", "152.143.123.131###", "+1 (017) 555-7713", "123-45-6789",
        "+1 (826) 555-4081 190.137.1.2", "7536784127813050 4845168114407329", "415-555-1234", "x 999.1.1.1 y", "000-12-3456",
        "v1.2.3.4.5", "token = \"44e15e09fd311c3cf3163b66d5a9875b883d8ce2\"",
    ]
    got = replaced(*texts)
    for text, (new, found, values) in zip(texts[:8], got):
        assert re.sub(r"[^\W\d_]", "a", re.sub(r"\d+", "9", new)) == re.sub(r"[^\W\d_]", "a", re.sub(r"\d+", "9", text)) and found
    assert all(new != text for text, (new, *_) in zip(texts[:6], got))
    assert got[5][1] == ["+1 (826) 555-4081", "190.137.1.2"] and all(a != b for a, b in zip(got[5][1], got[5][2]))
    assert len(got[6][1]) == 2
    assert [g[0] for g in got[8:]] == texts[8:]
    assert got[0][0].endswith("@example.com") and re.fullmatch(r"[A-Z][a-z]\.[A-Z][a-z]{2}\+[a-z]\d@example\.com", got[0][0])
    assert got[3][0].startswith("+1 (")


def test_one_phone_number_however_it_is_separated(replaced):
    for code, spellings in {
        "1": ("+1 (415) 555-1234", "+14155551234", "+1.415.555.1234"),
        "7": ("+7 495 123 45 67", "+74951234567"),
        "49": ("+49 151 1234 5678", "+4915112345678", "+49-151-1234-5678", "+491 5112 345 678"),
        "353": ("+353 85 123 4567", "+353851234567"),
    }.items():
        for text, (new, found, _) in zip(spellings, got := replaced(*spellings)):
            assert found == [text] and re.sub(r"\d", "9", new) == re.sub(r"\d", "9", text)
        digits, = {re.sub(r"\D", "", new) for new, *_ in got}
        old = re.sub(r"\D", "", spellings[0])
        rest = [int(d) for d in old[len(code):]]
        assert digits == code + "".join(map(str, permuted(rest, [10] * len(rest), "phone"))) != old


def test_key_decides_and_ids_link(replaced):
    text = "a 10.0.0.1 b 10.0.0.1 c"
    (one, _, values), = replaced(text)
    (two, *_), = replaced(text, key="other")
    assert values[0] == values[1] and one != two
    pair = permuted([10 * 256, 1], [65536] * 2, "ip")
    assert values[0] == ".".join(str(x) for v in pair for x in divmod(v, 256))


def test_null_empty_and_very_long_texts(replaced, docs_of):
    long = "word " * 100_000 + "10.0.0.1"
    got = replaced(None, "", "nothing", long)
    assert [g[0] for g in got[:3]] == [None, "", "nothing"] and got[3][0][:500_000] == long[:500_000] and got[3][0] != long
    assert p.report(docs_of([]), KEY).count() == 0
    same = docs_of([(1, "10.0.0.1"), (1, "10.0.0.1"), (None, "x")])
    new = p.with_pseudonyms(same, KEY)
    assert new.columns == same.columns and new.count() == 3 and new.where("text = '10.0.0.1'").count() == 0


def test_no_python_in_the_plan(documents):
    plan = p.report(documents, KEY)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
