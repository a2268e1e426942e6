import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
from cases import frame, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.llm import pii

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = 0
        for i, d in enumerate(map(int, reversed(digits))):
            total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if passes(kind, m[0])]
    return [(a, PATTERNS[k][0], b) for a, k, b in sorted(found)]


@settings(max_examples=2000, deadline=None)
@given(st.text("0123.25@a-+ ()b%_é", max_size=40))
def test_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_cards_phones_and_long_words():
    text = "x 4111 1111 1111 1111, +1 (499) 555-6503 a.b@c.d-e.org 1.2.3.4.5.6.7.8 " + "a" * 100_000 + "@" + "9" * 100_000
    assert [k for _, k, _ in pii.base_spans(text)] == ["card", "phone", "email", "ip", "ip"]


NAMES = ("Zorbo", "Quuxa")


def secret_rows():
    """Documents in which a nickname gives a mail address away, and a common word doesn't."""
    rng = random.Random(11)
    rows = [(i, words(rng, 40)) for i in range(150)]
    for i in range(12):
        rows.append((200 + i, f"{words(rng, 12)} {NAMES[i % 2]} wrote the mail zed{i % 2}@mail.example.com {words(rng, 12)}"))
    return [*rows, (300, rows[-1][1]), *odd_rows()]


def plain_disclosing(rows, window, support, share):
    n = len(rows)
    words_of = [Counter(re.findall(r"\w+", (t or "").lower())) for _, t in rows]
    term = Counter(w for c in words_of for w in c)
    both, entity, around = Counter(), Counter(), defaultdict(set)
    for _, text in rows:
        text = text or ""
        spans = plain_spans(text)
        inside = {i for a, _, b in spans for i in range(a, b)}
        pairs = set()
        for a, kind, b in spans:
            name = f"{kind}:{text[a:b].lower()}"
            left = list(re.finditer(r"\w+", text[:a]))[-window:]
            right = [(m[0], m.start() + b, m.end() + b) for m in re.finditer(r"\w+", text[b:])][:window]
            near = [(m[0], m.start(), m.end()) for m in left] + right
            near = [w.lower() for w, x, y in near if not inside & set(range(x, y))]
            for w in near:
                pairs.add((name, w))
                around[name, w].add(tuple(near))
        both.update(pairs)
        entity.update({e for e, _ in pairs})
    out = set()
    for (e, w), k in both.items():
        content = math.log2(n / entity[e])
        if len(around[e, w]) >= support and content > 0 and math.log2(n * k / (term[w] * entity[e])) / content >= share:
            out.add((e, w))
    return out


def test_terms_that_disclose_against_brute_force(spark):
    rows = secret_rows()
    for share in (0.5, 0.9):
        found = pii.spans(frame(spark, rows), share=share).collect()
        pairs = plain_disclosing(rows, pii.WINDOW, pii.SUPPORT, share)
        assert any(w == "zorbo" for _, w in pairs) and not any(w == "the" for _, w in pairs)
        text_of = defaultdict(list)
        for d, t in rows:
            text_of[d].append(t or "")
        terms = {t for _, t in pairs}
        for r in found:
            own = [(x.start, x.kind, x.end) for x in r.found]
            text = next(t for t in text_of[r.doc_id] if [s for s in own if s[1] != "term"] == plain_spans(t) and all(t[a:b].lower() in terms for a, k, b in own if k == "term"))
            assert own == sorted(own, key=lambda s: (s[0], (*pii.KINDS, "term").index(s[1])))
            if r.doc_id is not None and 200 <= r.doc_id <= 300:
                assert any(text[a:b] in NAMES for a, k, b in own if k == "term")


def plain_found(rows, window, support, share):
    """Every row's id with all its spans, terms included, each pair judged by the stated formula."""
    judged = []
    term, beside, both, entity, around = Counter(), Counter(), Counter(), Counter(), defaultdict(set)
    for doc, text in rows:
        text = text or ""
        spans = plain_spans(text)
        inside = {i for a, _, b in spans for i in range(a, b)}
        near = []
        for a, kind, b in spans:
            left = [(m[0].lower(), *m.span()) for m in re.finditer(r"\w+", text[:a])][-window:]
            right = [(m[0].lower(), m.start() + b, m.end() + b) for m in re.finditer(r"\w+", text[b:])][:window]
            own = [x for x in left + right if not inside & set(range(*x[1:]))]
            name = f"{kind}:{text[a:b].lower()}"
            near += [(name, *x) for x in own]
            for w, _, _ in own:
                around[name, w].add(" ".join(x[0] for x in own))
        term.update({w.lower() for w in re.findall(r"\w+", text)})
        beside.update({w for _, w, _, _ in near})
        both.update({(e, w) for e, w, _, _ in near})
        entity.update({e for e, _, _, _ in near})
        judged.append((doc, spans, near))

    def discloses(e, w):
        content = math.log2(len(rows) / entity[e])
        seen = len(around[e, w])
        if seen < support or content <= 0:
            return False
        pmi = math.log2(len(rows) * both[e, w] / (max(term[w], beside[w]) * entity[e]))
        return (pmi - math.log2((seen + pii.PRIOR) / seen)) / content >= share

    kinds = (*pii.KINDS, "term")
    out = Counter()
    for doc, spans, near in judged:
        terms = {(a, "term", b) for e, w, a, b in near if discloses(e, w)}
        out[doc, tuple(sorted([*spans, *terms], key=lambda s: (s[0], kinds.index(s[1]))))] += 1
    return out


def test_all_spans_are_exactly_those_of_brute_force(spark):
    rng = random.Random(13)
    rows = secret_rows()
    for i in range(60):  # entities of one to four mentions, neighbours in common, two side by side
        pair = f"p{i % 25}@x{i % 3}.org and +49 30 {1234500 + i % 20}"
        rows.append((500 + i, f"{words(rng, i % 9)} Dr Nam{i % 30} of Town{i % 7}, {pair} {words(rng, 3 + i % 5)}"))
    rows += [rows[-1], (None, rows[-2][1]), (None, None)]
    found_terms = []
    for share in (0.3, 0.5, 0.7, 0.9):
        got = Counter((r.doc_id, tuple((x.start, x.kind, x.end) for x in r.found)) for r in pii.spans(frame(spark, rows), share=share).collect())
        assert got == plain_found(rows, pii.WINDOW, pii.SUPPORT, share)
        found_terms.append(sum(n for (_, spans), n in got.items() for s in spans if s[1] == "term"))
    assert found_terms == sorted(found_terms, reverse=True) and found_terms[0] > found_terms[-1] > 0


def test_entities_mentioned_once_or_twice_are_judged(spark):
    rng = random.Random(12)
    rows = [(i, words(rng, 40)) for i in range(300)] + [(i, f"plain Ondrey {words(rng, 9)}") for i in range(300, 320)]
    rows += [(400, f"{words(rng, 9)} Vexil wrote from one@mail.example.com {words(rng, 9)}")]
    rows += [(410 + i, f"{words(rng, 9)} Tarbun and Ondrey wrote from two@mail.example.com {words(rng, 9)}") for i in (0, 1)]
    rows += [(420, rows[-1][1])]
    got = {r.doc_id: {t[x.start : x.end] for x in r.found if x.kind == "term"} for r, t in ((r, dict(rows)[r.doc_id]) for r in pii.spans(frame(spark, rows)).collect())}
    assert got == {d: {"Vexil"} if d == 400 else {"Tarbun"} if d >= 410 else set() for d, _ in rows}


def test_words_are_counted_as_they_are_lower_cased_near_entities(spark):
    texts = ["İsmail met İpek", "i smail", None, "İSMAİL İsmail"]
    batches = pii._frequencies(b"\xff" * 1024)(iter([pa.record_batch([pa.array(texts)], names=["text"])]))
    got = {r["term"]: r["n"] for b in batches for r in b.to_pylist()}
    assert got == {"İsmail".lower(): 2, "İSMAİL".lower(): 1, "met": 1, "İpek".lower(): 1, "i": 1, "smail": 1}


def test_counts_digests_and_strings_of_odd_documents(spark):
    rows = [*odd_rows(), (60, "mail a@b.co or +49 30 1234567 now"), (60, "mail a@b.co or +49 30 1234567 now")]
    got = pii.span_strings(pii.spans(frame(spark, rows))).collect()
    want = []
    for doc, text in rows:
        spans = plain_spans(text)
        own = ",".join(f"{k}:{a}:{b}" for a, k, b in spans)
        kinds = Counter(k for _, k, _ in spans)
        want.append(repr((doc, *[kinds[k] for k in pii.KINDS], hashlib.sha256(own.encode()).hexdigest(), own)))
    assert sorted(repr(tuple(r)) for r in got) == sorted(want)
    assert pii.spans(frame(spark, rows).limit(0)).collect() == []


def test_sanitised_texts(spark):
    docs = frame(spark, secret_rows())
    out = pii.sanitize(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    text = {r.doc_id: r.text for r in out.where("doc_id between 200 and 211").collect()}
    assert all("[EMAIL]" in t and not any(n in t for n in NAMES) and "example.com" not in t for t in text.values())
    assert pii.redact("ab cd ef", [(0, "email", 2, None), (3, "term", 5, 0.9), (1, "ip", 2, None)]) == "[EMAIL] [WORD] ef"
