"""Personal data by information-theoretic sanitisation.

Patterns find what is protected: mail addresses, IP addresses, card and phone numbers. A term
near a protected entity can reveal it. How much it does is estimated from all documents:

    PMI(term; entity) = log2(N * n(term, entity) / (n(term) * n(entity)))

against the entity's information content IC = log2(N / n(entity)); n counts documents, the pair
those in which the term stands within WINDOW words of the entity. How sure that is depends on the
pair's different surroundings, s, of which copies of one passage are one: the estimate is lowered by
log2((s + PRIOR) / s), as if the term had stood PRIOR times more elsewhere. A term that gives away at
least SHARE of the content by the lowered estimate, (PMI - that) >= SHARE * IC, is disclosed next to
that entity, also where that is mentioned once: `sanitize` generalises it to its shape, or removes it
where PMI gives away all.

A term's documents are counted over the whole corpus, for the terms that can matter, which are those
that would be disclosed if they stood near entities only, or in a part of the documents only: a bitmap of
fixed size tells workers which ones may, a join with the terms themselves tells which ones do.

Cases: null and empty texts have no spans. A pattern's failing match is dropped, not retried.
Null ids are kept. Rows that repeat an id and text have the same spans. No rows give none.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import free_names, narrow, small_batches, stored
from marketlens.session import durable

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Words on either side of an entity.
WINDOW = 8
#: Least number of surroundings: any pair is judged.
SUPPORT = 1
SHARE = 0.9
#: Of the lowered estimate: half a count, as usual for counts from 1 on.
PRIOR = 0.5
#: The first count of terms takes one in so many documents.
PARTS = 8
#: Bits of the bitmap of terms: 2 MB, at any size of the corpus.
FILTER_BITS = 1 << 24
REMEMBERED = 300_000
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\w+")
_NO_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, str, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Looks around each @, so that long words cost no more than their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", at + 1)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Runs of dotted numbers, four numbers at a time."""
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            parts, at = run[0].split("."), run.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                end = at + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    yield at, end
                at = end + 1


def luhn(digits: str) -> bool:
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) in code points, by start, then by kind."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    for a, b in _addresses(text):
        found.append((a, 1, b))
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NO_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def _near(text: str, spans: list[Span], window: int) -> Iterator[tuple[int, str, int, int, int]]:
    """(entity, term, start, end, surroundings) of words around each span that are in no span."""
    covered = np.zeros(len(text) + 1, dtype=bool)
    for a, _, b in spans:
        covered[a:b] = True
    for a, kind, b in spans:
        entity = xxhash.xxh64_intdigest(f"{kind}:{text[a:b].lower()}") - (1 << 63)
        # words are short: a stretch that surely holds `window` of them, or grows until it does
        reach = 16 * window
        while True:
            left = list(_WORD.finditer(text, max(0, a - reach), a))
            right = list(_WORD.finditer(text, b, min(len(text), b + reach)))
            if (len(left) > window or reach >= a) and (len(right) > window or b + reach >= len(text)):
                break
            reach *= 4
        words = [m for m in left[-window:] + right[:window] if not covered[m.start() : m.end()].any()]
        terms = [m[0].lower() for m in words]
        around = xxhash.xxh64_intdigest(" ".join(terms)) - (1 << 63)
        for m, term in zip(words, terms):
            yield entity, term, m.start(), m.end(), around


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()), ("sig", pa.int64()),
        *[(f"n_{k}", pa.int64()) for k in KINDS],
        ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))),
        ("base_sha256", pa.string()),
        ("near", pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("around", pa.int64())]))),
    ]
)
_FOUND_DDL = (
    "doc_id long, sig long, n_email long, n_ip long, n_card long, n_phone long, base array<struct<start:int,kind:string,end:int>>, "
    "base_sha256 string, near array<struct<entity:long,term:string,start:int,end:int,around:long>>"
)


def _find(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base, digests, near = [], [], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                kinds = Counter(kind for _, kind, _ in spans)
                counts.append([kinds[k] for k in KINDS])
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                digests.append(hashlib.sha256(joined(spans).encode()).hexdigest())
                near.append([dict(zip(("entity", "term", "start", "end", "around"), x)) for x in _near(text, spans, window)] if spans else [])
            columns = [batch.column("doc_id"), batch.column("sig"), *[[c[i] for c in counts] for i in range(len(KINDS))], base, digests, near]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND
            )

    return run


def _frequencies(bitmap: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        bits, mask = bitmap, len(bitmap) * 8 - 1
        counts: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])
            counts.clear()
            return rows

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word in {w.lower() for w in set(_WORD.findall(text or ""))}:
                    may = known.get(word)
                    if may is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        place = xxhash.xxh64_intdigest(word, 42) & mask
                        may = known[word] = bool(bits[place >> 3] >> (place & 7) & 1)
                    if may:
                        counts[word] += 1
            if len(counts) >= REMEMBERED:
                yield counted()
        yield counted()

    return run


def _bitmap(terms: DataFrame, bits: int) -> bytes:
    """The terms' XXH64, cut to the bits' number, as bits; built where the terms are."""
    place = F.xxhash64("term").bitwiseAND(F.lit(bits - 1))
    rows = terms.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    out = bytearray(bits // 8)
    # buckets count from 1 for positive places; place 0 has a bucket of its own, 0
    for r in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        part = bytes(r["bits"])
        if r["bucket"] == 0:
            out[0] |= 1
            continue
        # bit b of bucket k stands for the place (k - 1) * 32768 + b + 1
        places = np.flatnonzero(np.unpackbits(np.frombuffer(part, dtype=np.uint8), bitorder="little")) + (r["bucket"] - 1) * 32768 + 1
        for p in places.tolist():
            if p < bits:
                out[p >> 3] |= 1 << (p & 7)
    return bytes(out)


def disclosing(found: DataFrame, docs: DataFrame, support: int = SUPPORT, share: float = SHARE, bits: int = FILTER_BITS) -> DataFrame:
    """(entity, term, given): pairs whose term gives away at least `share` of the entity's content."""
    holding = found.where("size(near) > 0")
    near = holding.select(F.explode("near").alias("x")).select("x.*")
    surroundings = near.select("entity", "term", "around").distinct().groupBy("entity", "term").agg(F.count("*").alias("seen"))
    each = holding.select(
        F.explode(F.array_distinct(F.transform("near", lambda x: F.struct(x["entity"].alias("entity"), x["term"].alias("term"))))).alias("x")
    )
    together = each.groupBy("x.entity", "x.term").agg(F.count("*").alias("n_both"))
    holders = holding.select(F.explode(F.array_distinct(F.transform("near", lambda x: x["entity"]))).alias("entity"))
    holders = holders.groupBy("entity").agg(F.count("*").alias("n_entity"))
    beside = holding.select(F.explode(F.array_distinct(F.transform("near", lambda x: x["term"]))).alias("term"))
    _, beside = stored(beside.groupBy("term").agg(F.count("*").alias("n_near")))
    total = F.lit(float(max(docs.count(), 1)))
    content = F.log2(total / F.col("n_entity"))
    unsure = F.log2((F.col("seen") + PRIOR) / F.col("seen"))

    def pmi(n_term: str) -> Column:
        return F.log2(total * F.col("n_both") / (F.col(n_term).cast("double") * F.col("n_entity")))

    pairs = durable(surroundings.where(F.col("seen") >= support).join(together, ["entity", "term"]).join(holders, "entity"))
    # a term is in as many documents as it stands near entities in, at least
    pairs = durable(pairs.join(beside, "term").where(content > 0).where((pmi("n_near") - unsure) / content >= share))
    def counted(some: DataFrame, pairs: DataFrame, out: str) -> DataFrame:
        terms = some.select("text").mapInArrow(_frequencies(_bitmap(pairs.select("term").distinct(), bits)), "term string, n long")
        # a piece of a word, cut by an entity within it, may be no word of the corpus
        terms = terms.groupBy("term").agg(F.sum("n").alias("n_corpus"))
        return pairs.join(terms, "term", "left").withColumn(out, F.greatest("n_corpus", "n_near")).drop("n_corpus")

    # common words fail by what a part of the documents holds of them, so the whole is counted for rare ones
    part = docs.where(F.pmod(F.xxhash64("text"), F.lit(PARTS)) == 0)
    pairs = durable(counted(part, pairs, "n_part").where((pmi("n_part") - unsure) / content >= share).drop("n_part"))
    judged = counted(docs, pairs, "n_term")
    return judged.where((pmi("n_term") - unsure) / content >= share).select("entity", "term", (pmi("n_term") / content).alias("given"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """A row per document: doc_id, sig (hash of its text), counts per kind, base_sha256, and `found`: all
    spans as (start, kind, end, given), sorted; given is null for the patterns' own."""
    small_batches(docs.sparkSession)
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = durable(rows.withColumn("sig", F.xxhash64("text")).mapInArrow(_find(window), _FOUND_DDL))
    _, pairs = stored(disclosing(found, rows, support, share))
    near = found.where("size(near) > 0").select("doc_id", "sig", F.explode("near").alias("x")).select("doc_id", "sig", "x.*")
    terms = near.join(pairs, ["entity", "term"]).groupBy("doc_id", "sig", "start", "end").agg(F.max("given").alias("given"))
    own = F.struct(F.col("start"), F.lit(TERM).alias("kind"), F.col("end"), F.col("given"))
    terms = terms.groupBy(F.col("doc_id").alias("__id"), F.col("sig").alias("__sig")).agg(F.collect_list(own).alias("terms"))
    base = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), F.lit(None).cast("double").alias("given")))
    kinds = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    table = found.join(terms, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("sig") == F.col("__sig")), "left")
    every = F.concat(base, F.coalesce("terms", F.expr("array()").cast("array<struct<start:int,kind:string,end:int,given:double>>")))
    ranked = F.array_sort(F.transform(every, lambda x: F.struct(x["start"].alias("start"), F.array_position(kinds, x["kind"]).alias("place"), x["kind"].alias("kind"), x["end"].alias("end"), x["given"].alias("given"))))
    return table.select(
        "doc_id", "sig", *[f"n_{k}" for k in KINDS], "base_sha256",
        F.transform(ranked, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["given"].alias("given"))).alias("found"),
    )


def span_strings(found: DataFrame) -> DataFrame:
    """`spans` with the spans joined to one string per document."""
    one = F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", F.array_join(one, ",").alias("spans"))


def shape(term: str) -> str:
    """What a disclosing term is generalised to."""
    return "[NUMBER]" if term.isdigit() else "[NAME]" if term[:1].isupper() else "[WORD]"


def redact(text: str, spans_of: list[tuple[int, str, int, float | None]]) -> str:
    """The text with protected entities named by kind, disclosing terms generalised or removed."""
    out, at = [], 0
    for start, kind, end, given in sorted(spans_of, key=lambda x: (x[0], -x[2])):
        if end <= at:
            continue
        if start >= at:
            out.append(text[at:start])
            out.append(f"[{kind.upper()}]" if kind != TERM else "" if given is not None and given >= 1 else shape(text[start:end]))
        at = end
    return "".join(out) + text[at:]


def sanitize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the text sanitised."""
    own_id, sig, own_spans, key = free_names(docs, "__id", "__sig", "__found", "__text")
    found = spans(docs, id_col, text_col).select(F.col("doc_id").alias(own_id), F.col("sig").alias(sig), F.col("found").alias(own_spans)).dropDuplicates([own_id, sig])

    @F.arrow_udf("string")
    def clean(text: pa.Array, found_in: pa.Array) -> pa.Array:
        rows = zip(text.to_pylist(), found_in.to_pylist())
        return pa.array([t if t is None else redact(t, [(x["start"], x["kind"], x["end"], x["given"]) for x in own]) for t, own in rows], pa.string())

    keyed = docs.withColumn(key, F.xxhash64(docs[text_col]))
    both = keyed.join(found, keyed[id_col].cast("long").eqNullSafe(found[own_id]) & (keyed[key] == found[sig]))
    return both.withColumn(text_col, clean(keyed[text_col], F.col(own_spans))).select(*docs.columns)
