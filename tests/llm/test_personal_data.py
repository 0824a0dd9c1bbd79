import hashlib
import random
import re

from marginwatch.llm.personal_data import digests, find_personal_data, luhn, spans_of

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(t):
    out = [("email", m) for m in EMAIL.finditer(t)]
    out += [("ip", m) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m) for m in CARD.finditer(t) if 12 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
    out += [("phone", m) for m in PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    order = {"email": 0, "ip": 1, "card": 2, "phone": 3}
    return [(k, *m.span()) for k, m in sorted(out, key=lambda x: (x[1].start(), order[x[0]]))]


def texts():
    random.seed(11)
    known = ["", None, "a.b@c.de%d@e.f x@y @z.w a@@b.c", "é 4056225709817009 ü", "+1 (614) 555-8001 ingin", "1.2.3.4.5.6.7.8 300.1.1.1", "1.2.3 4.5.6.7",
             "4111 1111 1111 1111", "4111-1111  1111-1111", "a" * 300_000 + "@b.c", "1" * 200_000, "1." * 100_000, "+" + "(" * 100_000, "@" * 1000, "x@" * 5000 + "y.z"]
    parts = ["a", "b.c", "@", ".", "1", "12", "255", "256", "+", " ", "-", "(", ")", "4111111111111111", "\n", "é", "x@y.z", "+49 30 1234567"]
    return known + ["".join(random.choice(parts) for _ in range(random.randint(1, 40))) for _ in range(3000)]


def test_base_kinds_match_the_plain_patterns():
    base = {"email", "ip", "card", "phone"}
    for t in texts():
        if t and len(t) < 10_000:
            assert [s[:3] for s in spans_of(t) if s[0] in base] == brute(t), t


def test_long_runs_take_linear_time():
    for t in texts():
        if t and len(t) >= 10_000:
            spans_of(t)
    assert spans_of("a" * 300_000 + "@b.c")[0][:3] == ("email", 0, 300_004)


def test_checks_and_context_decide_further_kinds():
    assert [s[:3] for s in spans_of("Pay to GB82 WEST 1234 5698 7654 32 today")] == [("iban", 7, 34)]
    assert spans_of("Pay to GB83 WEST 1234 5698 7654 32 today") == []
    assert spans_of("code 021000021 here") == [] and spans_of("routing code 021000021 here")[0][0] == "routing"
    assert spans_of("n 415 555 2671") == [] and spans_of("phone 415 555 2671")[0][0] == "local_phone"
    with_word, without = (spans_of(t)[0][3] for t in ("card 4056225709817009", "x 4056225709817009"))
    assert with_word > without


def test_query_columns(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts()[:200])] + [(None, "a@b.c", "x"), (1, "a@b.c", "y")]
    got = digests(find_personal_data(spark.createDataFrame(rows, "doc_id long, text string, spans string"))).collect()
    want = []
    for i, t, _ in rows:
        b = brute(t) if t and len(t) < 10_000 else None
        if b is not None:
            want.append((i, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in b).encode()).hexdigest(), *[sum(x[0] == k for x in b) for k in ("email", "ip", "card", "phone")]))
    have = {(r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got}
    assert set(want) <= have and len(got) == len(rows)
    assert next(r for r in got if r.doc_id == 0).spans == ""
    assert find_personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_iban_before_capitals_and_digits():
    for text, iban in [("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF", "DE89 3704 0044 0532 0130 00"), ("account GB29 NWBK 6016 1331 9268 19 I paid", "GB29 NWBK 6016 1331 9268 19"),
                       ("IBAN DE89370400440532013000 2024 EUR", "DE89370400440532013000"), ("IBAN NO93 8601 1117 947 USD", "NO93 8601 1117 947")]:
        assert [text[a:b] for kind, a, b, _ in spans_of(text) if kind == "iban"] == [iban], text
    assert not [s for s in spans_of("IBAN DE89 3704 0044 0532 0130 01 BIC COBADEFF") if s[0] == "iban"]
