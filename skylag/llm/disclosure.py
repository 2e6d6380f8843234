"""Personal data, and the words that give it away: information-theoretic sanitisation."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import free_name, row_key, text_of
from skylag.llm.registry import documents, query
from skylag.session import written

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a leftmost match begins where its digits begin, so no other start is tried
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")

# words on each side of a mention that count as its context
WINDOW = 6
# contexts of one entity in which a term must occur, and the share of what identifies the entity
# that a term must reveal: 1 where every document with the term names the entity
SUPPORT, GENERALISE, REMOVE = 3, 0.8, 0.95
FILTER_BITS = 1 << 20


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if i % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def personal_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; offsets count characters."""
    out = [("email", *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGITS.findall(m.group()))
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.findall(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def entity(kind: str, value: str) -> str:
    """A mention's entity: letters in lower case, numbers by their digits."""
    return f"{kind}:{value.lower()}" if kind in ("email", "ip") else (
        f"{kind}:{''.join(_DIGITS.findall(value))}"
    )


def context(text: str, start: int, end: int, spans) -> list[str]:
    """Distinct words beside a mention, without those of mentions themselves."""
    reach = WINDOW * 40
    left = [(m.start(), m.end()) for m in _WORD.finditer(text, max(0, start - reach), start)]
    right = [(m.start(), m.end()) for m in _WORD.finditer(text, end, min(len(text), end + reach))]
    words = left[-WINDOW:] + right[:WINDOW]
    return sorted({
        text[a:b].lower() for a, b in words if not any(a < y and x < b for _, x, y in spans)
    })


def bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % FILTER_BITS


def term_filter(terms: DataFrame) -> frozenset[int]:
    """Hash values of the terms, FILTER_BITS of them at most, whatever the number of terms.

    The filter only keeps words from leaving their task in vain; a join with the terms decides.
    """
    value = F.pmod(F.crc32(F.encode("term", "utf-8")), F.lit(FILTER_BITS)).cast("int")
    rows = terms.select(value.alias("b")).distinct().toArrow()
    return frozenset(rows.column("b").to_pylist())


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[bytes, str]]:
    for key, text in zip(batch.column("_key"), batch.column("text")):
        yield key.as_py(), text.as_py()


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_key, spans and the distinct contexts of each distinct (id, text)."""
    schema = (
        "_key binary, spans array<struct<kind:string,start:long,end:long>>, "
        "contexts array<struct<entity:string,terms:array<string>>>"
    )
    as_arrow = pa.schema([
        ("_key", pa.binary()),
        ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
        ("contexts", pa.list_(pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))]))),
    ])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, spans, contexts = [], [], []
            for key, text in _texts(batch):
                found = personal_spans(text)
                keys.append(key)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                contexts.append([
                    {"entity": entity(k, text[a:b]), "terms": context(text, a, b, found)}
                    for k, a, b in found
                ])
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip((keys, spans, contexts), as_arrow.types)],
                schema=as_arrow,
            )

    texts = docs.select(row_key(id_col, text_col).alias("_key"), text_of(text_col).alias("text"))
    return texts.mapInArrow(scan, schema)


def _occurrences(texts: DataFrame, wanted: frozenset[int], places: bool) -> DataFrame:
    """Words whose hash is wanted: how many documents of a batch have them, or where they stand."""
    schema = "_key binary, term string, start long, end long" if places else "term string, n long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}

        def is_wanted(word: str) -> bool:
            if word not in known:
                if len(known) > 1_000_000:
                    known.clear()
                known[word] = bucket(word) in wanted
            return known[word]

        for batch in batches if wanted else ():
            counts, rows = Counter(), []
            for key, text in _texts(batch):
                if places:
                    rows += [
                        (key, m.group().lower(), m.start(), m.end())
                        for m in _WORD.finditer(text) if is_wanted(m.group().lower())
                    ]
                else:
                    words = {w.lower() for w in set(_WORD.findall(text))}
                    counts.update(w for w in words if is_wanted(w))
            if places:
                keys, terms, starts, ends = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(terms, pa.string()),
                     pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                    ["_key", "term", "start", "end"],
                )
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                    ["term", "n"],
                )

    return texts.mapInArrow(scan, schema)


def revealing_terms(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """term, disclosure: the most of what identifies any entity that the term gives away.

    With n documents in all, a of them with the term, b contexts of the entity and c of those
    with the term, disclosure is log((c/a) / (b/n)) / log(n/b): pointwise mutual information over
    what there is to know. Contexts with the same words count once, so copies of a document prove
    nothing; the term's documents are all counted.
    """
    contexts = (
        found.select(F.explode("contexts").alias("c")).select("c.entity", "c.terms").distinct()
    )
    contexts = written(contexts, "pii-contexts")
    size = contexts.groupBy("entity").agg(F.count("*").alias("b"))
    pairs = (
        contexts.select("entity", F.explode("terms").alias("term")).groupBy("entity", "term")
        .agg(F.count("*").alias("c")).filter(F.col("c") >= SUPPORT)
    )
    pairs = written(pairs.join(size, "entity"), "pii-pairs")
    texts = docs.select(F.lit(None).cast("binary").alias("_key"), text_of(text_col).alias("text"))
    counts = (
        _occurrences(texts, term_filter(pairs), places=False)
        .groupBy("term").agg(F.sum("n").alias("a"))
    )
    n = F.lit(float(max(docs.count(), 2)))
    b = F.least(F.col("b").cast("double"), n - 1)
    share = F.least(F.col("c") / F.col("a"), F.lit(1.0))
    return (
        pairs.join(counts, "term")
        .select("term", (F.log(share * n / b) / F.log(n / b)).alias("disclosure"))
        .groupBy("term").agg(F.max("disclosure").alias("disclosure"))
        .filter(F.col("disclosure") >= GENERALISE)
    )


def disclosures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (id, text): _key, spans (kind, start, end).

    Base kinds are email, ip, card and phone; `generalise` and `remove` mark every place, in any
    document, of a term that reveals an entity. The corpus is read three times: mentions with
    their contexts, documents of the terms in question, places of the revealing terms. Terms meet
    in joins; a task gets a filter of fixed size.

    A null text counts as empty and has no spans, and so has a table without rows. Rows that
    repeat id and text are one. Further columns are ignored.
    """
    found = written(find_personal(docs, id_col, text_col).dropDuplicates(["_key"]), "pii-found")
    terms = written(revealing_terms(docs, found, text_col), "pii-terms")
    texts = docs.select(row_key(id_col, text_col).alias("_key"), text_of(text_col).alias("text"))
    kind = F.when(F.col("disclosure") >= REMOVE, "remove").otherwise("generalise")
    places = (
        _occurrences(texts, term_filter(terms), places=True).join(terms, "term")
        .groupBy("_key").agg(F.collect_set(F.struct(kind.alias("kind"), "start", "end")).alias("_more"))
    )
    return found.join(places, "_key", "left").select(
        "_key", "spans", F.array_sort(F.coalesce("_more", F.array())).alias("more")
    )


def joined(spans) -> F.Column:
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )


def replace_spans(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each mention replaced by its kind, revealing terms by their shape or by none."""
    out, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start < at:
            continue
        shape = "[Name]" if text[start].isupper() else "[word]"
        out += [text[at:start], {"remove": "", "generalise": shape}.get(kind, f"[{kind}]")]
        at = end
    return "".join(out) + text[at:]


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with `text_col` sanitised and all their other columns; null stays null.

    Empty texts stay as they are; rows that repeat id and text are equal afterwards. No rows give no rows.
    """
    key, spans, found_key = (free_name(docs, n) for n in ("_key", "_spans", "_found"))
    found = disclosures(docs, id_col, text_col).select(
        F.col("_key").alias(found_key), F.concat("spans", "more").alias(spans)
    )

    @F.pandas_udf("string")
    def clean(text, spans):
        import pandas as pd

        return pd.Series([
            t if t is None or s is None
            else replace_spans(t, [(x["kind"], x["start"], x["end"]) for x in s])
            for t, s in zip(text, spans)
        ])

    keyed = docs.withColumn(key, row_key(id_col, text_col))
    return (
        keyed.join(found, keyed[key] == found[found_key], "left")
        .withColumn(text_col, clean(text_col, spans)).select(*docs.columns)
    )


@query("op8_disclosure")
def op8(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = disclosures(docs)

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    ids = docs.select("doc_id", row_key().alias("_key"))
    return ids.join(found, "_key").select(
        "doc_id", *map(count, KINDS), F.sha2(joined(F.col("spans")), 256).alias("base_sha256"),
        joined(F.concat("spans", "more")).alias("spans"),
        F.size("more").cast("long").alias("n_terms"),
    )
