"""Benchmark decontamination through a distributed positional index (operator 10, native).

Words are runs of ASCII letters and digits and all characters beyond ASCII,
with A-Z lower-cased.  A window is ``window`` consecutive words of a test item,
or all words of a shorter one.

Of every window the rarest terms that documents have, by their counts over all
documents, are its anchors; a window with a term that no document has gives
proximity matches only.  The index stores
the postings (term, document, position) of the anchor terms.  An item's lists
are intersected by adjusting offsets: a posting at p of the item's word q says
that the item may begin at p - q, and where a window occurs all its anchors
agree.  Places that enough anchors agree on are compared word by word, which
gives every occurrence of every window (phrases); places that agree to within a
few words give proximity matches.

Document terms are joined to the items' terms by broadcast only after those
have been counted (``max_broadcast``); beyond that the join shuffles.  Counting
is partially aggregated; hot terms and hot documents load no single task.

Everything is DataFrame functions.  Defined results: null texts have no words;
an item with a null id hits words but is listed nowhere; items of one text each
count; rows that repeat doc_id and text get equal results; other columns pass
through unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroseries.llm.repeats import KEY, boxed, keyed
from aeroseries.llm.store import write_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text; none of a null."""
    text = F.coalesce(text, F.lit(""))
    # lower() is quick on ASCII, and there it is what is asked for.
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    return F.array_remove(F.split(low, GAP), "")


def bounded(table: DataFrame, most: int) -> DataFrame:
    """``table`` marked for broadcast if its counted size allows."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def _upto(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def item_words(items: DataFrame, window: int) -> DataFrame:
    """(iid, item_id, words, size, starts): items with words.

    ``size`` is the length of their windows, ``starts`` where each different
    window first begins; ``words`` end with the last of these.
    """
    rows = items.select("item_id", F.xxhash64("item_id", "text").alias("iid"), words_of(F.col("text")).alias("words")).dropDuplicates(["iid"])
    rows = rows.where(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(window)))
    every = rows.select("iid", "words", "size", F.explode(_upto(F.size("words") - F.col("size") + 1)).alias("s"))
    first = every.groupBy("iid", F.slice("words", F.col("s") + 1, F.col("size")).alias("win")).agg(F.min("s").alias("s"))
    first = first.groupBy("iid").agg(F.sort_array(F.collect_list("s")).alias("starts"))
    return rows.join(first, "iid").select("iid", "item_id", F.slice("words", F.lit(1), F.array_max("starts") + F.col("size")).alias("words"), "size", "starts")


def term_counts(docs: DataFrame, terms: DataFrame, max_broadcast: int) -> DataFrame:
    """(term, freq): how often each of ``terms`` occurs in all documents."""
    tokens = docs.select(F.explode(words_of(F.col("text"))).alias("term"))
    return tokens.join(bounded(terms, max_broadcast), "term", "left_semi").groupBy("term").agg(F.count("*").alias("freq"))


def anchors(items: DataFrame, counts: DataFrame, rarest: int) -> DataFrame:
    """(iid, q, term, need): of each different window, the positions q of its rarest terms among those that documents have.

    ``need``: how many must agree where the window occurs; null where only windows with an unseen term have this anchor.
    """
    starts = items.select("iid", "words", "size", F.explode("starts").alias("s"))
    places = starts.select("iid", "s", "size", F.posexplode(F.slice("words", F.col("s") + 1, F.col("size"))).alias("j", "term")).join(counts, "term")
    one = Window.partitionBy("iid", "s")
    ranked = places.withColumn("q", F.col("s") + F.col("j"))
    ranked = ranked.withColumns({"r": F.row_number().over(one.orderBy("freq", "q")), "known": F.count("*").over(one)}).where(F.col("r") <= rarest)
    need = F.when(F.col("known") == F.col("size"), F.least("size", F.lit(rarest)))
    return ranked.groupBy("iid", "q", "term").agg(F.min(need).alias("need"))


def postings(docs: DataFrame, terms: DataFrame, max_broadcast: int) -> DataFrame:
    """The positional index of ``terms``, written in the shared folder: (term, k, t, p), each file with whole documents."""
    tokens = docs.select(*KEY, F.posexplode(words_of(F.col("text"))).alias("p", "term"))
    return write_table(tokens.join(bounded(terms, max_broadcast), "term", "left_semi").select("term", *KEY, "p"), "postings")[0]


def diagonals(index: DataFrame, anchor: DataFrame, max_broadcast: int) -> DataFrame:
    """(iid, k, t, d, q, need): for each posting of an anchor, the place d where its item would begin."""
    return index.join(bounded(anchor, max_broadcast), "term").select("iid", *KEY, (F.col("p") - F.col("q")).alias("d"), "q", "need")


def phrases(docs: DataFrame, items: DataFrame, agreed: DataFrame, part: int = 1 << 16) -> DataFrame:
    """(iid, k, t, spans): the occurrences [lo, hi) of an item's windows, from places (iid, k, t, d).

    A document's places travel in parts of ``part`` words, each as one row beside the text.
    """
    sized = agreed.join(items.select("iid", F.size("words").alias("n")), "iid")
    parts = sized.groupBy(*KEY, F.floor(F.col("d") / part).alias("part")).agg(F.collect_set(F.struct("iid", "d", "n")).alias("places"))
    held = docs.select(*KEY, "text").join(parts, KEY)

    def cut(w: Column, x: Column) -> Column:
        # An item that would begin before the document lacks its first words there.
        lead = F.greatest(-x["d"], F.lit(0))
        return F.struct(x["iid"].alias("iid"), x["d"].alias("d"), lead.alias("lead"), F.slice(w, F.greatest(x["d"], F.lit(0)) + 1, F.greatest(x["n"] - lead, F.lit(0))).alias("cut"))

    # The words are a lambda's variable, so that they are split once for all places.
    cuts = F.flatten(F.transform(F.array(words_of(F.col("text"))), lambda w: F.transform("places", lambda x: cut(w, x))))
    both = held.select(*KEY, F.explode(cuts).alias("x")).select(*KEY, "x.*").dropDuplicates([*KEY, "iid", "d"]).join(items.select("iid", "words", "size", "starts"), "iid")
    same = both.withColumn("same", F.transform("words", lambda x, i: F.coalesce(F.get("cut", i - F.col("lead")) == x, F.lit(False))))
    starts = F.filter("starts", lambda s: F.forall(F.sequence(F.lit(0), F.col("size") - 1), lambda j: F.get("same", s + j)))
    found = same.select("iid", *KEY, F.transform(starts, lambda s: F.struct((F.col("d") + s).alias("lo"), (F.col("d") + s + F.col("size")).alias("hi"))).alias("spans"))
    return found.where(F.size("spans") > 0)


def proximity(agreement: DataFrame, anchor: DataFrame, max_broadcast: int, slop: int = 4, share: float = 0.6) -> DataFrame:
    """(iid, k, t, terms, lo): items of whose anchors ``share`` or more lie within ``slop`` words of one place.

    ``agreement`` are the places of ``diagonals``; they fall into two rows of
    buckets, half a bucket apart, so places up to ``slop`` apart share one.
    Only documents with that many places of an item at all are looked at so.
    """
    total = anchor.groupBy("iid").agg(F.countDistinct("q").alias("all"))
    many = agreement.groupBy("iid", *KEY).agg(F.count("*").alias("c")).join(total, "iid")
    many, _ = write_table(many.where(F.col("c") >= F.lit(share) * F.col("all")).select("iid", *KEY, "all"), "near-pairs")
    wide = 2 * slop
    buckets = F.array(2 * F.floor(F.col("d") / wide), 2 * F.floor((F.col("d") + slop) / wide) + 1)
    near = agreement.join(bounded(many, max_broadcast), ["iid", *KEY]).select("iid", *KEY, "all", "q", "d", F.explode(buckets).alias("b"))
    near = near.groupBy("iid", *KEY, "all", "b", "q").agg(F.min("d").alias("d"))
    near = near.groupBy("iid", *KEY, "all", "b").agg(F.count("*").alias("terms"), F.min("d").alias("lo"))
    enough = near.where(F.col("terms") >= F.lit(share) * F.col("all"))
    best = enough.groupBy("iid", *KEY).agg(F.max(F.struct("terms", (-F.col("lo")).alias("back"))).alias("best"))
    return best.select("iid", *KEY, "best.terms", (-F.col("best.back")).alias("lo"))


def covered(spans: Column) -> Column:
    """How many places the spans cover."""
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["hi"] - F.greatest(x["lo"], acc["end"]))).alias("n"), F.greatest(acc["end"], x["hi"]).alias("end"))
    return F.aggregate(F.sort_array(spans), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda acc: acc["n"])


class Matches:
    """The index of one corpus for one benchmark, and what it answers."""

    def __init__(self, docs: DataFrame, items: DataFrame, window: int = 10, rarest: int = 3, max_broadcast: int = 1_000_000):
        self.docs, self.max_broadcast = keyed(docs), max_broadcast
        self.items, _ = write_table(item_words(items, window), "items")
        terms = self.items.select(F.explode("words").alias("term")).distinct()
        counts, _ = write_table(term_counts(self.docs, terms, max_broadcast), "term-counts")
        self.anchors, _ = write_table(anchors(self.items, counts, rarest), "anchors")
        self.index = postings(self.docs, self.anchors.select("term").distinct(), max_broadcast)
        self.places = diagonals(self.index, self.anchors, max_broadcast)

    def phrases(self) -> DataFrame:
        """(iid, k, t, spans) of every exact occurrence of a window."""
        agreed = self.places.groupBy("iid", *KEY, "d").agg(F.count("*").alias("c"), F.min("need").alias("need")).where("c >= need")
        agreed, _ = write_table(agreed.select("iid", *KEY, "d"), "places")
        return phrases(self.docs, self.items, agreed)

    def near(self, slop: int = 4, share: float = 0.6) -> DataFrame:
        """(iid, k, t, terms, lo) of the proximity matches."""
        return proximity(self.places, self.anchors, self.max_broadcast, slop, share)

    def proximity(self, slop: int = 4, share: float = 0.6) -> DataFrame:
        """(item_id, doc_id, terms, place): items most of whose anchors stand near one place of a document."""
        near = self.near(slop, share).join(self.items.select("iid", "item_id"), "iid")
        known = self.docs.select(*KEY, "doc_id").distinct()
        return near.join(known, KEY).select("item_id", "doc_id", "terms", F.col("lo").alias("place"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, near: bool = True, **parameters) -> DataFrame:
    """One row per row of ``docs``: doc_id, k, t, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    With ``near`` also n_near, the number of items with a proximity match.
    """
    matches = Matches(docs, items, window, **parameters)
    found = matches.phrases().join(matches.items.select("iid", "item_id"), "iid")
    spans = found.select(*KEY, "item_id", F.explode("spans").alias("span"))
    hits = spans.groupBy(*KEY).agg(F.collect_set("item_id").alias("items"), F.collect_set("span").alias("spans"))
    names = F.sort_array(F.transform(F.coalesce("items", F.array().cast("array<bigint>")), lambda x: x.cast("string")))
    rows = matches.docs.select("doc_id", *KEY, F.size(words_of(F.col("text"))).cast("long").alias("n_words")).join(hits, KEY, "left")
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long")
    columns = [
        "doc_id", *KEY, "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "spans",
    ]
    if near:
        close = matches.near().join(matches.items.select("iid", "item_id"), "iid").groupBy(*KEY).agg(F.countDistinct("item_id").alias("n_near"))
        rows = rows.join(close, KEY, "left")
        columns.append(F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
    return rows.select(*columns)


def clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` without a hit, all their columns."""
    bad = decontaminate(docs, items, window, near=False).where("contaminated").select(*KEY)
    return boxed(docs).join(bad, KEY, "left_anti").select("row.*")


DIGEST = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
FIGURES = [*DIGEST, "n_near"]
_WORDS = "[x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> '']"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win
       FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)),
wins AS (SELECT DISTINCT n, win FROM bw),
dw AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM wins) AS l WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.n, dw.s, dw.win FROM dw JOIN wins ON dw.n = wins.n AND dw.win = wins.win),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT DISTINCT hits.doc_id, bw.item_id FROM hits JOIN bw ON hits.n = bw.n AND hits.win = bw.win),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM found GROUP BY doc_id),
dt AS (SELECT doc_id, unnest(w) AS term, unnest(range(0, len(w))) AS p FROM d),
freqs AS (SELECT term, count(*) AS freq FROM dt GROUP BY term),
starts AS (SELECT item_id, win, min(s) AS s
           FROM (SELECT item_id, s, w[s + 1:s + n] AS win FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS s FROM b WHERE len(w) > 0))
           GROUP BY item_id, win),
terms AS (SELECT item_id, s, unnest(win) AS term, s + unnest(range(0, len(win))) AS q FROM starts),
ranked AS (SELECT item_id, term, q, row_number() OVER (PARTITION BY item_id, s ORDER BY freq, q) AS r FROM terms JOIN freqs USING (term)),
anchor AS (SELECT DISTINCT item_id, term, q FROM ranked WHERE r <= 3),
goal AS (SELECT item_id, count(DISTINCT q) AS n FROM anchor GROUP BY item_id),
marks AS (SELECT DISTINCT item_id, doc_id, q, p - q AS d FROM anchor JOIN dt USING (term)),
buckets AS (SELECT item_id, doc_id, q, 2 * floor(d / 8.0) AS b FROM marks UNION ALL SELECT item_id, doc_id, q, 2 * floor((d + 4) / 8.0) + 1 FROM marks),
close AS (SELECT item_id, doc_id FROM buckets JOIN goal USING (item_id) GROUP BY item_id, doc_id, b, n HAVING count(DISTINCT q) >= CAST(0.6 AS DOUBLE) * n),
near AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM close GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN places ON d.doc_id = places.doc_id LEFT JOIN named ON d.doc_id = named.doc_id LEFT JOIN near ON d.doc_id = near.doc_id
"""
