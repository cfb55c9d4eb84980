import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from costseries.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def slow(text):
    def digits(s):
        return "".join(c for c in s if c.isdigit())

    def luhn(s):
        doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(s))]
        return sum(n // 10 + n % 10 for n in doubled) % 10 == 0

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-_+ (0)é25", max_size=40))
def test_base_spans_equal_the_patterns(text):
    assert pii.detect(text) == slow(text)


def test_base_spans_of_the_samples(table):
    for r in table("documents").collect():
        assert pii.detect(r.text) == slow(r.text)


CASES = {
    "mail joe[at]ex.com now": ["joe[at]ex.com"],
    "or bob (at) mail (dot) example (dot) org!": ["bob (at) mail (dot) example (dot) org"],
    "jane at example dot com is": ["jane at example dot com"],
    "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ x": ["ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"],
    "jоe@exаmple.com": ["jоe@exаmple.com"],
    "é plus one five five five one two three four five six seven": ["plus one five five five one two three four five six seven"],
    "four four six four seven six one seven zero three six nine zero three four five": ["four four six four seven six one seven zero three six nine zero three four five"],
    "ip one nine two dot one six eight dot one dot one end": ["one nine two dot one six eight dot one dot one"],
    "4464 7617​0369 0345": ["4464 7617​0369 0345"],
    "we met at the dot and two or three of us": [],
    "look at this. dot com": [],
    "one two three": [],
}


def test_disguises_map_back_to_the_source():
    chain = pii.Transducers()
    for text, expected in CASES.items():
        base, both = chain.spans(text)
        assert [text[a:b] for _, a, b in both] == expected, text
        assert set(base) <= set(both)


def test_samples_hold_no_disguise(table):
    chain = pii.Transducers()
    for r in table("documents").collect():
        base, both = chain.spans(r.text)
        assert base == both


def test_very_long_words_take_one_pass():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 50_000, "+1" * 50_000, "(" * 100_000, "one " * 20_000):
        pii.Transducers().spans(text)


def test_odd_rows(odd, no_docs, docs):
    got = pii.find(odd).collect()
    assert len(got) == odd.count()
    assert all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if r.doc_id in (1, 2, 3))
    one = pii.find(docs((1, "x 1.2.3.4 a@b.co 1.2.3.4"))).collect()[0]
    assert one.spans == "email:10:16,ip:2:9,ip:17:24" and (one.n_email, one.n_ip) == (1, 2)
    assert pii.find(no_docs).count() == 0


def test_many_addresses_take_time_in_proportion():
    import time

    chain = pii.Transducers()
    start = time.process_time()
    base, both = chain.spans("a@b.co " * 150_000 + "x [at] y.com")
    assert len(base) == 150_000 and len(both) == 150_001
    assert time.process_time() - start < 20
