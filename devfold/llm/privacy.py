"""Personal data by pattern, and terms that reveal it by corpus co-occurrence.

Patterns find the protected entities. The corpus then says how strongly a nearby term
reveals one: with probabilities per word of the corpus, ``PMI(term, entity) / IC(entity)`` is the
share of the entity's information that the term discloses (1 when the term occurs only
beside it). Terms above ``REMOVE`` are removed, those above ``GENERALISE`` replaced by a
class of terms. Evidence must come from ``SUPPORT`` different contexts, so copies of one text
count once. Evidence is pooled: a word counts for the value beside it (as digits for numbers), for its kind, and for the
domain of a mail address, so values that occur once add up. Only words near an entity leave the first pass; corpus counts of terms are
combined per batch before they are shuffled. A term found so is marked wherever it occurs: a second
pass sends the words whose hash is set in a bitmap of the terms, and a join keeps the terms among them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devfold.llm import words as W
from devfold.llm.common import BATCH_BYTES, STAGE_BATCH_BYTES, free_name, id_and_text, release, small_batches, written
from devfold.llm.jaccard import bucketed
from devfold.llm.substrings import squeeze, unsqueeze

KINDS = ("email", "ip", "card", "phone", "term")
#: Words looked at on either side of an entity; contexts a term needs; thresholds of disclosure.
REACH, SUPPORT, GENERALISE, REMOVE = 5, 3, 0.90, 0.97
#: Distinct words counted in one bucket, about.
BUCKET_ROWS = 1_000_000
#: Bits of a term's hash that index the bitmap, at least and at most (32 MB); one row holds ``2**LEAST_BITS`` of them.
LEAST_BITS, MOST_BITS = 16, 28

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the longest local part before it and domain after it, left to right."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(done, at + 1))


def entities(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all pattern finds, in code points, by start and kind."""
    out = [(s, 0, e) for s, e in emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def key_of(text: str) -> int:
    """A signed 64-bit key of a string."""
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def pools(kind: int, value: str) -> tuple[int, int, int | None]:
    """Keys of what a find is evidence for: its value in one spelling, its kind and, for mail, its domain."""
    name, value = KINDS[kind], value.lower()
    if name == "ip":
        value = ".".join(p.lstrip("0") or "0" for p in value.split("."))
    elif name in ("card", "phone"):
        value = "".join(c for c in value if c.isdigit())
    return key_of(f"{name}:{value}"), key_of(f"kind:{name}"), key_of(f"domain:{value.rpartition('@')[2]}") if name == "email" else None


def nearby(text: str, spans: list[tuple[int, int, int]], reach: int) -> list[tuple[tuple[int, int, int | None], str, int, int, int, int]]:
    """For each entity, its pools, and term, context key, start and end of each word within reach that no entity touches.

    Last come bits of the pools for which the word counts here for the first time: it may stand beside two entities of one pool.
    """
    out, seen = [], set()
    for start, kind, end in spans:
        keys = pools(kind, text[start:end])
        left = _words_before(text, start, reach)
        right = _words_after(text, end, reach)
        context = key_of("\x00".join(text[a:b] for a, b in left) + "\x01" + "\x00".join(text[a:b] for a, b in right))
        for a, b in left + right:
            if not any(s < b and a < e for s, _, e in spans):
                first = sum(1 << i for i, key in enumerate(keys) if (key, a) not in seen)
                seen.update((key, a) for key in keys)
                out.append((keys, text[a:b], context, a, b, first))
    return out


def _words_before(text: str, start: int, reach: int) -> list[tuple[int, int]]:
    """Up to ``reach`` words that end at or before ``start``; the text is read only as far as needed."""
    size = 64 * reach
    while True:
        low = max(0, start - size)
        found = [(low + m.start(), low + m.end()) for m in _WORD.finditer(text[low:start])]
        if low == 0 or len(found) > reach:
            break
        size *= 2
    return found[-reach:] if reach else []


def _words_after(text: str, end: int, reach: int) -> list[tuple[int, int]]:
    found = []
    for m in _WORD.finditer(text, end):
        found.append((m.start(), m.end()))
        if len(found) == reach:
            break
    return found


FOUND = (
    "doc_id long, row_key long, n_words long, n_email long, n_ip long, n_card long, n_phone long, base string, "
    "near array<struct<entity: long, kind: long, domain: long, term: long, context: long, start: int, end: int, shape: string, first: int>>"
)


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Pattern finds of every row ``(doc_id, text, row_key)``, and the words around them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("entity", pa.int64()), ("kind", pa.int64()), ("domain", pa.int64()), ("term", pa.int64()), ("context", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("shape", pa.string()), ("first", pa.int32())]))
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            counts = W.split(batch.column(1)).counts
            for text in batch.column(1).to_pylist():
                spans = entities(text or "")
                number = [sum(k == i for _, k, _ in spans) for i in range(4)]
                words = nearby(text, spans, reach) if spans else []
                terms = _term_keys([w[1] for w in words])
                near = [{"entity": e[0], "kind": e[1], "domain": e[2], "term": t, "context": c, "start": a, "end": b, "shape": _shape(w), "first": f} for (e, w, c, a, b, f), t in zip(words, terms, strict=True)]
                for column, value in zip(out, (*number, spelled(spans), near), strict=True):
                    column.append(value)
            kinds = (pa.int64(),) * 4 + (pa.string(), kind)
            columns = [pa.array(v, t) for v, t in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts), *columns], names=["doc_id", "row_key", "n_words", "n_email", "n_ip", "n_card", "n_phone", "base", "near"])
            release()

    return docs.mapInArrow(find, FOUND)


def _term_keys(terms: list[str]) -> list[int]:
    """Keys of single words, as the corpus counts know them."""
    if not terms:
        return []
    words = W.split(pa.array(terms), lower=True)
    return W.word_hashes(words).view(np.int64).tolist()


def _shape(word: str) -> str:
    """The class that stands for a word."""
    if any(c.isdigit() for c in word):
        return "<NUMBER>"
    return "<NAME>" if word[:1].isupper() else "<WORD>"


def word_counts(docs: DataFrame) -> DataFrame:
    """``(term, n)``: occurrences of every word in the corpus, A-Z lower-cased."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(12, size // 40 // BUCKET_ROWS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = np.unique(W.word_hashes(W.split(batch.column(1), lower=True)), return_counts=True)
            _, bounds = bucketed(keys, buckets)
            held = np.flatnonzero(np.diff(bounds))
            cells = [squeeze(keys[bounds[b] : bounds[b + 1]]) for b in held]
            sums = [n[bounds[b] : bounds[b + 1]].astype("<u4").tobytes() for b in held]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(cells, pa.binary()), pa.array(sums, pa.binary())], names=["bucket", "keys", "counts"])
            release()

    def add(table: pa.Table) -> pa.Table:
        keys = np.concatenate([unsqueeze(x) for x in table.column("keys").to_pylist()])
        n = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()])
        distinct, which = np.unique(keys, return_inverse=True)
        out = pa.table({"term": distinct.view(np.int64), "n": np.bincount(which, n, len(distinct)).astype(np.int64)})
        release()
        return out

    cells = docs.mapInArrow(count, "bucket int, keys binary, counts binary")
    return cells.groupBy("bucket").applyInArrow(add, "term long, n long")


def _pooled(found: DataFrame, *columns: str) -> DataFrame:
    """One row for each word near an entity and each pool of that entity, whose key is ``entity``; ``n`` is 1 at its first time there."""
    near = found.where(F.size("near") > 0).select("doc_id", "row_key", F.explode("near").alias("x"))
    keys = [F.struct(F.col(f"x.{name}").alias("entity"), F.shiftright("x.first", i).bitwiseAND(F.lit(1)).cast("long").alias("n")) for i, name in enumerate(("entity", "kind", "domain"))]
    each = near.select("doc_id", "row_key", "x", F.explode(F.array(*keys)).alias("p")).where("p.entity IS NOT NULL")
    return each.select("doc_id", "row_key", "p.entity", "p.n", *[f"x.{c}" for c in columns])


def disclosures(found: DataFrame, docs: DataFrame, support: int = SUPPORT, least: float = GENERALISE) -> DataFrame:
    """``(entity, term, disclosure)`` of the terms that reveal an entity, or a pool of them, to at least ``least``."""
    total = found.agg(F.sum("n_words")).first()[0] or 0
    each = _pooled(found, "term", "context").groupBy("entity", "term", "context").agg(F.sum("n").alias("n"))
    joint = each.groupBy("entity", "term").agg(F.sum("n").alias("both"), F.count(F.lit(1)).alias("contexts")).where(F.col("contexts") >= support)
    # occurrences of an entity: its contexts once per row and place
    places = _pooled(found, "context")
    own = places.groupBy("entity", "doc_id", "row_key", "context").agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    known = joint.join(own, "entity").join(word_counts(docs), "term")
    information = F.log2(F.lit(float(max(total, 2))) / F.col("n_entity"))
    mutual = F.log2(F.col("both") * F.lit(float(max(total, 2))) / (F.col("n") * F.col("n_entity")))
    share = F.when(information > 0, mutual / information).otherwise(F.lit(0.0))
    return known.select("entity", "term", share.alias("disclosure")).where(F.col("disclosure") >= least)


def bitmap(terms: DataFrame, bits: int) -> np.ndarray:
    """One bit for each value of the first ``bits`` bits of a key, set where a term has it."""

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        cell = np.zeros(1 << LEAST_BITS, bool)
        cell[table.column("slot").to_numpy()] = True
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(cell).tobytes()], pa.binary())})

    slot = F.shiftrightunsigned("term", 64 - bits)
    slots = terms.select(F.shiftright(slot, LEAST_BITS).alias("part"), slot.bitwiseAND(F.lit((1 << LEAST_BITS) - 1)).alias("slot")).distinct()
    out = np.zeros(1 << (bits - 3), np.uint8)
    for part, raw in slots.groupBy("part").applyInArrow(fill, "part long, bits binary").collect():
        at = part << (LEAST_BITS - 3)
        out[at : at + (1 << (LEAST_BITS - 3))] = np.frombuffer(raw, np.uint8)
    return out


def occurrences(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(doc_id, row_key, term, start, end, shape)`` of every word that may be a term and that no entity touches.

    All occurrences of ``terms`` are among them, and a few other words whose hash begins alike.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, terms.count().bit_length() + 6))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(terms, bits))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            words = W.split(batch.column(1), lower=True)
            keys = W.word_hashes(words)
            slot = (keys >> np.uint64(64 - bits)).astype(np.int64)
            hit = np.flatnonzero(held[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1)
            if not len(hit):
                continue
            # code points before each byte
            points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80, dtype=np.int32)])
            rows = np.searchsorted(words.first, hit, "right") - 1
            origin = points[words.offsets[rows]]
            start, end = points[words.start[hit]] - origin, points[words.end[hit]] - origin
            out: list[list] = [[] for _ in range(6)]
            for row, at in zip(*np.unique(rows, return_index=True), strict=True):
                last = int(np.searchsorted(rows, row, "right"))
                doc_id, text, own = (batch.column(i)[row].as_py() for i in range(3))
                spans = entities(text)
                ends = np.maximum.accumulate([e for _, _, e in spans]) if spans else np.zeros(0)
                # the entities that begin before a word ends; the furthest of them must end before the word begins
                before = np.searchsorted([s for s, _, _ in spans], end[at:last]) - 1
                for i, j in enumerate(before.tolist(), int(at)):
                    a, b = int(start[i]), int(end[i])
                    if j < 0 or ends[j] <= a:
                        for column, value in zip(out, (doc_id, own, int(keys[hit[i]].view(np.int64)), a, b, _shape(text[a:b])), strict=True):
                            column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], names=["doc_id", "row_key", "term", "start", "end", "shape"])
            release()

    return docs.mapInArrow(find, "doc_id long, row_key long, term long, start int, end int, shape string")


def find_personal(docs: DataFrame, reach: int = REACH, support: int = SUPPORT, least: float = GENERALISE, everywhere: bool = False, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Finds of every row: counts per kind, base digest, all spans, and terms to generalise or remove.

    ``spans`` holds the pattern finds and the revealing terms as ``kind:start:end`` in code
    points, by start, then kind; ``terms`` repeats the latter with disclosure and class.
    With ``everywhere`` each occurrence of a revealing term is marked, with its highest disclosure; without,
    those beside the entity that it reveals.
    A null or empty text has none. Rows are judged one by one; rows alike in id and text get
    the same answer. Empty tables give no row; only ``doc_id`` and ``text`` are read.
    """
    small_batches(docs.sparkSession, batch_bytes)
    rows = id_and_text(docs).withColumn("row_key", _row_key())
    found = written(scan(rows, reach))
    risky = disclosures(found, rows, support, least)
    near = _pooled(found, "term", "start", "end", "shape").drop("n")
    if everywhere:
        risky = written(risky.groupBy("term").agg(F.max("disclosure").alias("disclosure")))
        # words cut by an entity are beside it only
        near = found.select("doc_id", "row_key", F.explode("near").alias("x")).select("doc_id", "row_key", "x.term", "x.start", "x.end", "x.shape").unionByName(occurrences(rows, risky))
    hits = near.join(risky, ["term"] if everywhere else ["entity", "term"]).groupBy("doc_id", "row_key", "start", "end", "shape").agg(F.max("disclosure").alias("disclosure"))
    terms = hits.groupBy(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure", "shape"))).alias("terms"))
    joined = found.drop("near", "n_words").join(terms, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_key") == F.col("_key")), "left").drop("_id", "_key")
    # base spans come by start and kind; a term is the last kind and never shares a start with them
    split = F.filter(F.split("base", ","), lambda x: x != "")
    base = F.transform(split, lambda x: F.struct(F.split(x, ":")[1].cast("int").alias("start"), F.when(x.startswith("email"), 0).when(x.startswith("ip"), 1).when(x.startswith("card"), 2).otherwise(3).alias("kind"), x.alias("text")))
    extra = F.transform(F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,disclosure:double,shape:string>>")), lambda x: F.struct(x["start"].alias("start"), F.lit(4).alias("kind"), F.concat_ws(":", F.lit("term"), x["start"].cast("string"), x["end"].cast("string")).alias("text")))
    spans = F.array_join(F.transform(F.sort_array(F.concat(base, extra)), lambda x: x["text"]), ",")
    return joined.select("doc_id", "row_key", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"), "terms")


def sanitised(docs: DataFrame, remove: float = REMOVE, **options: object) -> DataFrame:
    """Documents with personal data replaced by its kind and revealing terms generalised or removed.

    All columns stay, whatever they are called; ``n_chars``, where there is one, becomes the new length. A null text stays null.
    Rows with null or repeated ids are told apart by their texts; rows alike in both get the same new text. An empty table stays empty.
    """
    names = docs.columns
    at = names.index("text")
    own, key, spans, terms = (free_name(docs, x) for x in ("_id", "_key", "_spans", "_terms"))
    # smaller batches: the workers hold what other stages left in them
    finds = find_personal(docs, everywhere=True, **{"batch_bytes": STAGE_BATCH_BYTES} | options).where("spans <> ''").select(F.col("doc_id").alias(own), F.col("row_key").alias(key), F.col("spans").alias(spans), F.col("terms").alias(terms)).dropDuplicates([own, key])
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own)) & (_row_key() == F.col(key))
    joined = docs.join(finds, same, "left").select(*names, spans, terms)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            texts = columns[at].to_pylist()
            for i, (found, extra) in enumerate(zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True)):
                if found:
                    texts[i] = replaced(texts[i], found, {t["start"]: (t["disclosure"], t["shape"]) for t in extra or ()}, remove)
            columns[at] = pa.array(texts, pa.string())
            if "n_chars" in names:
                place = names.index("n_chars")
                sizes = [None if t is None else len(t) for t in texts]
                columns[place] = pa.array(sizes).cast(columns[place].type)
            yield pa.RecordBatch.from_arrays(columns[: len(names)], names=names)
            release()

    return joined.mapInArrow(rewrite, docs.schema)


def _row_key() -> Column:
    """What tells rows of one id apart: a 64-bit hash of the text."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def replaced(text: str, spans: str, terms: dict[int, tuple[float, str]], remove: float) -> str:
    """``text`` with each span replaced; of overlapping spans the first one counts, extended over the others."""
    out, done = [], 0
    for kind, start, end in (x.split(":") for x in spans.split(",")):
        a, b = int(start), int(end)
        if a < done:
            done = max(done, b)
            continue
        out.append(text[done:a])
        if kind != "term":
            out.append(f"<{kind.upper()}>")
        elif terms[a][0] < remove:
            out.append(terms[a][1])
        done = b
    return "".join([*out, text[done:]])
