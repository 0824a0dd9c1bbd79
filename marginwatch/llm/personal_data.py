"""Personal data in texts: patterns propose spans, checksums confirm them, context words move a score.

The base kinds (email, ip, card, phone) are decided by their pattern and check alone. Further kinds are
weaker patterns that stay only with a score at or above a threshold: a checksum (mod-97 of an IBAN, the
3-7-1 sum of a bank routing number) and words near by raise it.

One scan of a text for runs of digits finds the candidates of every kind but email; a kind's own pattern
then looks at the run alone. All patterns are linear in the text's length.
"""
from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "routing", "local_phone")
#: Score of a pattern alone, what its check adds, what a context word adds.
SCORES = {"email": (0.8, 0.0, 0.15), "ip": (0.6, 0.0, 0.2), "card": (0.3, 0.5, 0.2), "phone": (0.6, 0.1, 0.2),
          "iban": (0.3, 0.6, 0.1), "routing": (0.1, 0.3, 0.3), "local_phone": (0.4, 0.0, 0.3)}
CONTEXT = {"email": {"email", "mail", "contact", "write"}, "ip": {"ip", "address", "host", "server"}, "card": {"card", "visa", "credit", "debit", "payment"},
           "phone": {"phone", "tel", "call", "fax", "mobile", "cell"}, "iban": {"iban", "account", "bank", "konto", "cuenta", "compte"},
           "routing": {"routing", "aba", "bank", "account", "transit"}, "local_phone": {"phone", "tel", "call", "fax", "mobile", "cell"}}
THRESHOLD = 0.6
#: Characters before and after a span in which context words are looked for.
NEAR = 60

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_RUN = re.compile(r"[0-9](?:[ .-]?[0-9])+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an IBAN by country; of other countries, any number from 15 to 34.
_IBAN_SIZES = {c: int(n) for n, cs in {
    15: "NO", 16: "BE", 18: "DK FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for c in cs.split()}
_LOCAL_PHONE = re.compile(r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}")
_WORD = re.compile(r"[^\W\d_]+")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _iban(text: str, start: int) -> tuple[int, int] | None:
    """The longest IBAN from start that ends where a group does: capitals and digits that follow it may look like more groups."""
    m = _IBAN.match(text, start)
    end = m.end() if m else start
    while end > start:
        compact = text[start:end].replace(" ", "")
        if len(compact) < 15:
            break
        if len(compact) == _IBAN_SIZES.get(compact[:2], len(compact)) and mod97(compact):
            return start, end
        end = text.rfind(" ", start, end)
    return None


def _emails(text: str):
    """Each @ has one candidate: all allowed characters before it, back to the last match, and the longest domain after."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end:  # in steps, so that the text between is copied once
            back = max(end, start - 256)
            found = _LOCAL_END.search(text[back:start])
            if found is None:
                break
            start = back + found.start()
            if start > back:
                break
        domain = start < at and _DOMAIN.match(text, at + 1)
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def spans_of(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, by start and then in the order of KINDS."""
    found = [("email", a, b) for a, b in _emails(text)]
    weak = []
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    for run in _RUN.finditer(text):
        a, b = run.span()
        if "." in run[0]:
            found += [("ip", *m.span()) for m in _IP.finditer(text, a, b) if all(map(_small, m.groups()))]
        for m in _CARD.finditer(text, a, b):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
            elif len(m[0]) == 9 == len(digits) and sum(int(d) * w for d, w in zip(digits, (3, 7, 1) * 3)) % 10 == 0:
                weak.append(("routing", *m.span()))
        if a >= 2 and "A" <= text[a - 1] <= "Z" and "A" <= text[a - 2] <= "Z" and not text[a - 3:a - 2].isalnum():
            if iban := _iban(text, a - 2):
                weak.append(("iban", *iban))
        if _LOCAL_PHONE.fullmatch(run[0]):
            weak.append(("local_phone", a, b))
    base = sorted((a, b) for _, a, b in found)
    starts = [a for a, _ in base]
    out = [(kind, a, b, _score(text, kind, a, b)) for kind, a, b in found]
    for kind, a, b in weak:
        k = bisect_left(starts, b)
        if all(e <= a for _, e in base[max(0, k - len(BASE_KINDS)):k]) and (score := _score(text, kind, a, b)) >= threshold:
            out.append((kind, a, b, score))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _score(text: str, kind: str, start: int, end: int) -> float:
    base, check, context = SCORES[kind]
    near = f"{text[max(0, start - NEAR):start]} {text[end:end + NEAR]}".lower()
    return round(base + check + context * any(w in CONTEXT[kind] for w in _WORD.findall(near)), 3)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id and spans, an array of (kind, start, end, score) in code points.

    A null or empty text has no spans. Spans of one kind do not overlap; of different kinds they may, but
    a further kind never overlaps a base kind. Rows that repeat an id stay rows of their own; a null id
    stays null; an empty table gives no row; other columns are ignored. No row moves: the scan's tasks do it all."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    names = ("kind", "start", "end", "score")

    def run(batches):
        for batch in batches:
            spans = [[dict(zip(names, s)) for s in spans_of(t or "", threshold)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double>>")


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(spans, s -> s.kind in (" + ", ".join(f"'{k}'" for k in BASE_KINDS) + "))"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(F.expr(joined.format(base)), 256).alias("base_sha256"), F.expr(joined.format("spans")).alias("spans"),
                        F.expr("transform(spans, s -> s.score)").alias("scores"))
