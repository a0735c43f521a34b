import hashlib
import re

from ledgerlane.llm import pii
from ledgerlane.llm.queries import QUERIES


SF = "/root/testdata/sf0.001"
# Written as the contract has them, with retries and all.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m.group())]


TEXTS = [
    None, "", " ", "a.b@c.d_e@f.g h@i", "x@y.z@w.v.u.", "1.2.3.4.5.6.7.8 256.1.1.1 000255.01.1.9 1.2.3", "é€😀 joe@mail.example.com 😀 10.0.0.255",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "5555555555554444 6011000990139424-1", "call +1 (555) 010-9999 now +49 ( ) . - 12 +1234567",
    "IBAN DE89 3700 0044 0532 0130 00 ok, GB82 WEST 1234 5698 7654 32", "DE89370400440532013001", "my ssn 123-45-6789, and then a rather long way further on the order 123-45-6789",
    'token = "0123456789abcdef0123"', "0123456789abcdef0123", "1.2.3.4 " * 300,
]


def found(df):
    return {r.doc_id: [(pii.KINDS[s.order].name, s.start, s.end) for s in r.spans] for r in pii.find_spans(df, ["doc_id"]).collect()}


def test_base_spans_of_the_corpus_and_of_edge_cases(docs, corpus):
    names = set(PLAIN)
    for df in (docs(TEXTS), corpus):
        got = found(df)
        for r in df.collect():
            assert [s for s in got[r.doc_id] if s[0] in names] == base_spans(r.text), r.text[:200]


def test_very_long_texts(docs):
    got = found(docs(["a" * 100_000, "1" * 100_000, "1." * 20_000, "+1" + "(" * 100_000, "a.b@c" + ".d" * 50_000]))
    assert got[0] == got[1] == got[3] == []
    assert got[2] == [("ip", k, k + 7) for k in range(0, 40_000, 8)]
    assert got[4] == [("email", 0, 100_005)]


def test_added_kinds_need_a_checksum_or_a_context(docs):
    got = found(docs(TEXTS))
    added = {i: [s[0] for s in spans if s[0] not in PLAIN] for i, spans in got.items()}
    assert added[11] == [] and added[12] == ["ssn"] and added[13] == ["secret"] and added[14] == []
    assert added[10] == ["iban"]  # the first number has a wrong checksum


def test_context_counts_on_either_side(docs):
    far = " and so on for a long way" * 2
    got = found(docs(["my ssn is 123-45-6789", "123-45-6789 is my social security number", "123-45-6789 (SSN)", f"123-45-6789{far} ssn", f"ssn{far} 123-45-6789",
                      "0123456789abcdef0123 token = ", 'token = "0123456789abcdef0123"']))
    assert [[s[0] for s in got[k]] for k in range(7)] == [["ssn"], ["ssn"], ["ssn"], [], [], [], ["secret"]]
    assert got[2] == [("ssn", 0, 11)]


def test_redaction(docs):
    rows = {r.doc_id: r for r in pii.redact(docs(TEXTS)).collect()}
    assert rows[0].text is None and rows[1].text == "" and rows[0].spans == "x"
    assert rows[6].text == "é€😀 <EMAIL> 😀 <IP>"
    assert rows[15].text == "<IP> " * 300
    assert pii.redact(docs(TEXTS)).columns == docs(TEXTS).columns


def test_empty_table_and_query(spark, docs):
    assert pii.find_spans(docs([]), ["doc_id"]).count() == 0
    rows = {r.doc_id: r for r in QUERIES["op3_pii"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        base = base_spans(r.text)
        want = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert rows[r.doc_id].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert rows[r.doc_id].n_email == sum(k == "email" for k, _, _ in base)


def plain_added(text):
    """Account numbers and keys by a second, plain way: every start, the length of the country, the checksum by whole numbers."""
    out = []
    for m in re.finditer(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}", text):
        n = next((n for n, codes in pii.IBAN_LENGTHS.items() if m[1] in codes.split()), 0)
        end, taken = m.start(), ""
        while n and len(taken) < n and end < len(text) and (text[end].isalnum() or text[end] == " " and text[end - 1] != " "):
            taken, end = taken + text[end].strip(), end + 1
        number = "".join(str(int(c, 36)) for c in taken[4:] + taken[:4])
        if n and len(taken) == n and not text[end : end + 1].isalnum() and taken.isupper() and int(number) % 97 == 1:
            out.append(("iban", m.start(), end))
    return out


NUMBERS = ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "FR1420041010050500013M02606", "NO9386011117947", "MT84MALT011000012345MTLCAST001S", "BE68 5390 0754 7034"]


def test_account_numbers_before_any_word(docs):
    texts = [f"IBAN {n}{tail}" for n in NUMBERS for tail in ("", " BIC COBADEFFXXX", " OK", " AND " + NUMBERS[0], " 12 34", ".", "X", " X1", "\nNEXT LINE")]
    texts += ["DE89370400440532013001 BIC X", "XX89370400440532013000", "IBAN DE89 3704 0044 0532 0130", "ID AB12 CD34 " + NUMBERS[1]]
    got = found(docs(texts))
    for i, t in enumerate(texts):
        assert [s for s in got[i] if s[0] == "iban"] == plain_added(t), t
    clean = {r.doc_id: r.text for r in pii.redact(docs(texts)).collect()}
    assert clean[1] == "IBAN <IBAN> BIC COBADEFFXXX" and clean[3] == "IBAN <IBAN> AND <IBAN>"


def test_keys_of_any_length_and_case(docs):
    texts = [f'token = "{k}"' for k in ("0123456789abcdef", "0123456789ABCDEF" * 10, "aB" * 5000, "0123456789abcde", "g" * 32)]
    got = found(docs(texts))
    assert [[s[0] for s in got[i]] for i in range(5)] == [["secret"], ["secret"], ["secret"], [], []]
    assert got[2] == [("secret", 9, 10_009)]
