import hashlib
import random
import re
import time

import pyarrow as pa
import pytest

from haulage.llm import pii
from haulage.llm.pii import KINDS, finds, hidden, luhn, masked, may_hide, op12_pii, personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 13 <= len(digits) <= 19 and total % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((k, *m.span()))
    return out


def test_base_is_what_the_patterns_find():
    pick = random.Random(1)
    for _ in range(20000):
        text = "".join(pick.choice(["@", ".", "a", "b-", "1", "25", "300", "+", " ", "-", "(", ")", "4111111111111111", "é", "_"])
                       for _ in range(pick.randrange(25)))
        assert finds(text) == plain(text), text


def added(text):
    found = hidden(text, finds(text))
    assert not found or may_hide(pa.array([text]))[0] or not pii._latin(text)
    return [(KINDS[k], text[a:b]) for k, a, b in found]


@pytest.mark.parametrize("text, expected", [
    ("write to jane (at) example (dot) org now", [("email", "jane (at) example (dot) org")]),
    ("jane[at]mail.example[dot]org", [("email", "jane[at]mail.example[dot]org")]),
    ("jane dot doe at example dot co dot uk.", [("email", "jane dot doe at example dot co dot uk")]),
    ("jane.doe AT example DOT com", [("email", "jane.doe AT example DOT com")]),
    ("jane @ example.org", [("email", "jane @ example.org")]),
    ("jаne@еxample.org", [("email", "jаne@еxample.org")]),  # Cyrillic a and e
    ("ｊａｎｅ＠ｅｘａｍｐｌｅ．ｏｒｇ x", [("email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｏｒｇ")]),
    ("ja​ne@exam­ple.org", [("email", "ja​ne@exam­ple.org")]),
    ("host １９２．168.0.1", [("ip", "１９２．168.0.1")]),
    ("host 192.l68.0.1", [("ip", "192.l68.0.1")]),
    ("one nine two dot one six eight dot zero dot one", [("ip", "one nine two dot one six eight dot zero dot one")]),
    ("card 4111 1111 1111 1111", [("card", "4111 1111 1111 1111")]),
    ("card 4111–1111–1111–1111", [("card", "4111–1111–1111–1111")]),
    ("four one one one " + "one " * 11 + "one end", [("card", "four one one one " + "one " * 11 + "one")]),
    ("call plus four four two zero seven nine four six double zero five eight",
     [("phone", "plus four four two zero seven nine four six double zero five eight")]),
    ("ruf plus vier neun eins fünf eins zwei drei vier fünf sechs sieben an",
     [("phone", "plus vier neun eins fünf eins zwei drei vier fünf sechs sieben")]),
    ("+1 five five five 0 one nine nine 42", [("phone", "+1 five five five 0 one nine nine 42")]),
])
def test_disguises_map_back_to_the_source(text, expected):
    assert added(text) == expected
    assert added(f"é 日本 {text} – ok") == expected


@pytest.mark.parametrize("text", [
    "look at example.com", "we met at noon dot", "he was at home (at last) today", "one two three four steps",
    "встреча в офисе и пример@кто.рф", "the point is at issue", "on one or two of the three", "see a.b (.) c", "x < at > y",
    "jane@example.org and 192.168.0.1 and 4111 1111 1111 1111 and +1 (017) 555-7713", "a b – c", None, "", " \n"])
def test_clean_texts_are_left_alone(text):
    assert text is None or added(text) == []


def test_base_stays_beside_wider_finds():
    text = "ja​ne@example.org"
    base = finds(text)
    assert [text[a:b] for _, a, b in base] == ["ne@example.org"]
    assert [text[a:b] for _, a, b in hidden(text, base)] == [text]


def test_texts_passed_over_hide_nothing():
    pick = random.Random(7)
    parts = ["one", "two", "vier", "fünf", " ", "  ", "-", ", ", "dot", " dot ", " at ", "(at)", "[ dot ]", "@", " @ ", ".", "1", "42",
             "O", "l", "+", "plus ", "double ", "jane", "org", "\n", "192.168.0.", "4111 ", "\t"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randrange(25))) for _ in range(30000)]
    for text, may in zip(texts, may_hide(pa.array(texts))):
        assert may or hidden(text, finds(text)) == [], text


@pytest.mark.parametrize("unit", ["a", "1", "1.", "a@", "@", "+1", "one ", "a dot ", "a at ", "(at)", "​", "а", "4111 ", "1O", "（", "a.a"])
def test_long_texts_take_time_in_proportion(unit):
    text = unit * (400_000 // len(unit))
    started = time.process_time()
    hidden(text, finds(text))
    assert time.process_time() - started < 10


def test_rows(frame, clashing, rows):
    texts = [r[1] for r in rows] + ["a@b.cd jane (at) example (dot) org +1 234 567 890"]
    docs = [(i, t, "", "", 0) for i, t in enumerate(texts)] + [(None, texts[-1], "", "", 0)] * 2
    out = personal_data(clashing(docs).repartition(3)).selectExpr("doc.doc_id", "spans").collect()
    assert len(out) == len(docs)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in out}
    assert spans[None] == [("email", 0, 6, False), ("email", 7, 34, True), ("phone", 35, 49, False)]
    assert {i: [(KINDS.index(k), a, b) for k, a, b, x in s if not x] for i, s in spans.items() if i is not None} == {
        i: plain(t) if len(t or "") < 50000 else finds(t) for i, t in enumerate(texts)}
    hid = masked(clashing(docs))
    assert hid.columns == clashing(docs).columns
    assert hid.where("doc_id IS NULL").first().text == "<email> <email> <phone>"
    assert personal_data(frame([])).count() == 0


def test_query(spark):
    import __spark_entry__ as entry

    out = op12_pii(spark, entry.SMOKE_DIR)
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    got = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    for r in spark.read.parquet(f"{entry.SMOKE_DIR}/documents.parquet").collect():
        base = plain(r.text)
        listed = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert got[r.doc_id][:5] == (*(sum(k == i for k, _, _ in base) for i in range(4)),
                                     hashlib.sha256(listed.encode()).hexdigest())
        assert set(listed.split(",")) <= set(got[r.doc_id][5].split(","))
    assert luhn("4111111111111111") and not luhn("4111111111111112")
