"""Whether cited snippets and figures stand in the source text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import folding
from ledgerloom.functions.rules import Rules, vote
from ledgerloom.functions.text import contains_ordered, fragments, norm, number_forms, squash
from ledgerloom.functions.workers import importable


PROBES = "doc string, kind int, page_no int, id string, page int, snippet string, forms array<string>, text string"
FOUND = "doc string, id string, snippet string, found boolean, on_page boolean"


def _in_order(hay: str, needles: list[str]) -> bool:
    at = 0
    for n in needles:
        if (i := hay.find(n, at)) < 0:
            return False
        at = i + len(n)
    return True


class _Stream:
    """One folding of a document, page after page, searched for the pieces of many probes at once.

    An automaton reports every occurrence of every piece in the order of their ends. A probe waits for one piece at a
    time; the first occurrence that begins behind the piece before is taken, which is what searching piece by piece finds.
    """

    def __init__(self, probes: list[list[str]]):
        self.left, self.end, uses = [len(p) for p in probes], [0] * len(probes), {}
        for i, pieces in enumerate(probes):
            for k, piece in enumerate(pieces):
                uses.setdefault(piece, []).append((i, len(pieces) - k))
        self.search = None
        if uses:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for piece, where in uses.items():
                automaton.add_word(piece, (len(piece), where))
            automaton.make_automaton()
            self.search = automaton.iter("")

    def feed(self, text: str) -> None:
        if self.search is None or not text:
            return
        self.search.set(text)
        for last, (size, where) in self.search:
            for i, left in where:
                if self.left[i] == left and last + 1 - size >= self.end[i]:
                    self.left[i], self.end[i] = left - 1, last + 1


class _Document:
    """The probes of a document and what its pages have shown of them so far."""

    def __init__(self) -> None:
        self.probes: list[tuple] = []
        self.pages, self.norm = 0, None

    def page(self, number: int, text: str) -> None:
        norm, squash = folding.norm_text(text), folding.squash_text(text)
        if self.norm is None:
            self._compile()
        self.norm.feed(norm if not self.pages else f" {norm}")
        self.squash.feed(squash)
        for i in self.cited.get(number, ()):
            parts, bare = self.pieces[i]
            self.on_page[i] = self.on_page[i] or bool(parts) and (_in_order(norm, parts) or _in_order(squash, bare))
        self.pages += 1

    def _compile(self) -> None:
        self.pieces, self.cited, self.on_page = [], {}, [False] * len(self.probes)
        norm, squash, self.of = [], [], []
        for i, (_, page, snippet, forms) in enumerate(self.probes):
            parts = [p for p in (x.strip() for x in re.split(r"\.{2,}|…", snippet or "")) if p]
            bare = [b for b in map(folding.squash_text, parts) if b]
            whole = [folding.norm_text(p) for p in parts]
            self.pieces.append((whole, bare))
            if page is not None and snippet is not None:
                self.cited.setdefault(page, []).append(i)
            alternatives = [bare] if parts else []
            alternatives += [[b] for b in map(folding.squash_text, forms or []) if b]
            self.of.append((len(norm) if parts else None, range(len(squash), len(squash) + len(alternatives))))
            norm += [whole] if parts else []
            squash += alternatives
        self.norm, self.squash = _Stream(norm), _Stream(squash)

    def rows(self) -> Iterator[tuple]:
        """id, snippet, found and on_page of each probe; null without any page."""
        for i, (id_, _, snippet, _) in enumerate(self.probes):
            if not self.pages:
                yield id_, snippet, None, None
                continue
            whole, others = self.of[i]
            found = (whole is not None and not self.norm.left[whole]) or any(not self.squash.left[k] for k in others)
            yield id_, snippet, bool(found), self.on_page[i]


def search_documents(probes: DataFrame, pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """The key, id, snippet, found, on_page of each probe (key, id, page, snippet, forms).

    A probe is found where the fragments of its snippet (parted by dots or an ellipsis) stand in order in the document, its
    pages (key, page_no, text) put together, on normalised or else on squashed text; or where one of its forms stands in
    the squashed text. on_page says whether the cited page (page is a page_no) has the snippet by itself. A snippet
    of signs only is squashed to nothing and counts as found, one without fragments doesn't. Documents without pages
    give null.

    Texts are shuffled once by document; a task reads each document's probes, then its pages in order, and holds one page
    and an automaton of the document's probes. The cost is that of the pages and the occurrences in them, however many the
    probes. Null pages are empty ones.
    """
    spark = importable(pages.sparkSession)
    null = lambda kind: F.lit(None).cast(kind)
    p = probes.select(F.col(key).cast("string").alias("doc"), F.lit(0).alias("kind"), null("int").alias("page_no"), F.col("id").cast("string").alias("id"), F.col("page").cast("int").alias("page"), "snippet", "forms", null("string").alias("text"))
    t = pages.select(F.col(key).cast("string").alias("doc"), F.lit(1).alias("kind"), F.col("page_no").cast("int").alias("page_no"), null("string").alias("id"), null("int").alias("page"), null("string").alias("snippet"), null("array<string>").alias("forms"), F.coalesce("text", F.lit("")).alias("text"))
    both = p.unionByName(t).where(F.col("doc").isNotNull())
    dealt = both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc").sortWithinPartitions("doc", "kind", "page_no")

    def each(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, held = None, _Document()
        out: list[tuple] = []
        for batch in it:
            for name, kind, number, id_, page, snippet, forms, text in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc", "kind", "page_no", "id", "page", "snippet", "forms", "text")), strict=True):
                if name != doc:
                    out += [(doc, *r) for r in held.rows()]
                    doc, held = name, _Document()
                if kind == 0:
                    held.probes.append((id_, page, snippet, forms))
                elif held.probes:
                    held.page(number, text)
            if len(out) > 5000:
                yield _found(out)
                out = []
        out += [(doc, *r) for r in held.rows()]
        yield _found(out)

    got = dealt.mapInArrow(each, FOUND)
    return got.select(F.col("doc").cast(dict(probes.dtypes)[key]).alias(key), "id", "snippet", "found", "on_page")


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=k) for i, k in enumerate(kinds)], names=["doc", "id", "snippet", "found", "on_page"])


def cited(cells: DataFrame, key: str) -> DataFrame:
    """The probes of cells with a value and a snippet; a probe's id is the cell's field."""
    return cells.where(F.col("value").isNotNull() & (F.col("snippet") != "")).select(key, F.col("field").alias("id"), F.col("page").cast("int").alias("page"), "snippet", F.lit(None).cast("array<string>").alias("forms"))


def valued(values: DataFrame, key: str) -> DataFrame:
    """The probes of positive values: their written forms."""
    return values.where(F.col("value") > 0).select(key, F.col("field").alias("id"), F.lit(None).cast("int").alias("page"), F.lit(None).cast("string").alias("snippet"), number_forms(F.col("value")).alias("forms"))


def ground(cells: DataFrame, pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """The key, field, snippet, found, on_page of cells with a value and a snippet; see search_documents()."""
    return search_documents(cited(cells, key), pages, key).withColumnRenamed("id", "field")


def numbers_present(values: DataFrame, pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """The key, field, found of positive values: whether one of a value's written forms stands in the document."""
    return search_documents(valued(values, key), pages, key).select(key, F.col("id").alias("field"), "found")


#: Probes that are broadcast at most: a hash and an item of each, about 50 bytes.
PROBES_SENT = 200_000


def snippet_hits(texts: DataFrame, snippets: DataFrame, key: str, item: str, pieces: int = 5) -> DataFrame:
    """(key, item) where a snippet stands in a text, on squashed text. Both sides are cut after squashing, at each of the
    letters a and e: what lies between two cuts of the snippet lies between two cuts of any text that holds it. A run of
    such pieces must be shared before the texts are searched, so that no cross join is made. Snippets with too few pieces
    are looked up by their first characters, as many as pieces or as they have. Snippets without letters and digits are
    nowhere. Runs are met as 64-bit hashes; the search decides. Where the snippets' runs are few enough to be
    sent to every task (they are counted), texts meet them where they are read, and only candidates are shuffled."""
    # what is cut is bound once by a transform over an array of one, or each slice would cut the text again
    gram = lambda n: lambda c: F.when(F.size(c) >= n, F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: F.xxhash64(F.concat_ws("|", F.slice(c, i + 1, n))))).otherwise(F.array().cast("array<bigint>"))
    grams = lambda x, at, n: F.array_distinct(F.get(F.transform(F.array(F.split(squash(x), at)), gram(n)), F.lit(0)))
    s = squash(F.col("text"))
    cut = snippets.where(F.length(s) > 0).select(item, F.split(s, "[ae]").alias("w"), F.split(s, "").alias("chars"))
    run = lambda c, start, n: F.xxhash64(F.concat_ws("|", F.slice(c, start, n))).alias("g")
    few = F.size("w") < pieces + 2
    sizes = {r.n: r["count"] for r in cut.select(F.when(few, F.least(F.size("chars"), F.lit(pieces))).otherwise(0).alias("n")).groupBy("n").count().collect()}
    sent = lambda probes, n: F.broadcast(probes) if n <= PROBES_SENT else probes
    pairs = texts.select(key, F.explode(grams(F.col("text"), "[ae]", pieces)).alias("g")).join(sent(cut.where(~few).select(item, run("w", 2, pieces)), sizes.get(0, 0)), "g").select(key, item)
    for n in range(1, pieces + 1):
        if sizes.get(n):
            brief = cut.where(few & (F.least(F.size("chars"), F.lit(pieces)) == n)).select(item, run("chars", 1, n))
            pairs = pairs.union(texts.select(key, F.explode(grams(F.col("text"), "", n)).alias("g")).join(sent(brief, sizes[n]), "g").select(key, item))
    pairs = pairs.distinct()
    j = pairs.join(texts.select(key, "text"), key).join(snippets.select(item, F.col("text").alias("snippet")), item)
    return j.where(squash(F.col("text")).contains(squash(F.col("snippet")))).select(key, item)


def ordered(hay: Column, snippet: Column) -> Column:
    return contains_ordered(norm(hay), F.transform(fragments(snippet), norm))


def repair_by_vote(records: DataFrame, pages: DataFrame, rules: Rules, current: str, clients: str) -> DataFrame:
    """A label that names a client is replaced by the pages' vote of one hit and more, a blank one by three and more."""
    v = vote(pages, "doc_id", "text", rules, "page_no")
    blank, client = F.col(current).isNull() | (F.trim(current) == ""), F.coalesce(F.col(current).rlike(f"(?iu){clients}"), F.lit(False))
    use = F.coalesce((client & (F.col("hits") >= 1)) | (blank & (F.col("hits") >= 3)), F.lit(False))
    return records.join(v, "doc_id", "left").withColumn("repaired", use).withColumn(current, F.when(use, F.col("label")).otherwise(F.col(current))).drop("label", "hits")
