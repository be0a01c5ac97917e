"""Source divergence audit: how far the term distributions of a language's sources lie apart.

Texts are counted where they lie: a task adds up (language, source, term) over all its documents
before anything is shuffled. A term is kept in a language if enough of its documents hold it. The
kept terms of a language are rows of a matrix, cut into blocks of BLOCK terms. For each source the
block has one indicator column for each count level that occurs in it, 0 included, with a one where
the term's count in the source is that level. The product of the matrix with its transpose is, for
each pair of sources, their joint table of levels: how many terms have level i here and level j
there. Such numbers are at most BLOCK, so the products are exact in floating point. A joint table is
priced with the distance of the two levels' probabilities, which are exact integers, one for each
level and not for each term; sums over blocks are taken by Spark. Columns are cut at COLUMNS, so a
product is of bounded size however many sources there are.

Null text, language or source is read as ''. Repeated rows count each. A language without kept terms
has distance 0 between its sources. An empty table gives no rows. Other columns are not read. Ranks
are by value, greatest first, then by item in the order of its UTF-8 bytes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import map_arrow, slices, written

DOCUMENTS = 30  # of a language that must hold a term
TERMS = 50  # listed of each group
SMOOTH = 5
SCALE = 1_000_000_000
BLOCK = 256  # terms, the rows of a product
COLUMNS = 2048  # indicator columns on one side of a product
HELD = 500_000  # counts a task holds before it hands them on

# Terms are runs of letters A-Z and of characters beyond ASCII, A-Z in lower case.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)
)


def counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, how often it occurs there (n) and in how many documents (docs). A row
    with a null term stands for each group, whatever terms it has."""
    schema = "lang string, source string, term string, n long, docs long"

    def rows(often: dict, held: dict) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), found in often.items():
            within = held[lang, source]
            for c, values in zip(columns, (
                [lang] * (len(found) + 1),
                [source] * (len(found) + 1),
                [None, *found],
                [0, *found.values()],
                [0, *map(within.__getitem__, found)],
            ), strict=True):
                c += values
        text = [pa.array(columns[i], pa.string()) for i in (0, 1)]
        terms = pa.array(columns[2], pa.binary()).cast(pa.string())
        numbers = [pa.array(columns[i], pa.int64()) for i in (3, 4)]
        names = ["lang", "source", "term", "n", "docs"]
        return pa.RecordBatch.from_arrays([*text, terms, *numbers], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often: dict = defaultdict(Counter)
        held: dict = defaultdict(Counter)
        for batch in batches:
            for part in slices(batch, "text"):
                for lang, source, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    terms = text.encode().translate(_TERM_BYTES).split()
                    often[lang, source].update(terms)
                    held[lang, source].update(set(terms))
                if sum(map(len, often.values())) > HELD:
                    yield rows(often, held)
                    often.clear()
                    held.clear()
        if often:
            yield rows(often, held)

    read = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    each = map_arrow(read, work, schema)
    return each.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def _blocks(kept: DataFrame) -> DataFrame:
    """Blocks of terms of the same language: lang, and for each count its term's row in the block,
    the number of its source and the count. A term is never in two blocks."""
    schema = "lang string, row array<int>, source array<int>, n array<long>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, list] = defaultdict(list)

        def block(lang: str) -> pa.RecordBatch:
            held = open_.pop(lang)
            row = np.repeat(np.arange(len(held), dtype=np.int32), [len(s) for s, _ in held])
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([lang]),
                "row": pa.array([row], pa.list_(pa.int32())),
                "source": pa.array([[s for x, _ in held for s in x]], pa.list_(pa.int32())),
                "n": pa.array([[n for _, x in held for n in x]], pa.list_(pa.int64())),
            })

        for batch in batches:
            for lang, sources, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                open_[lang].append((sources, n))
                if len(open_[lang]) == BLOCK:
                    yield block(lang)
        for lang in list(open_):
            yield block(lang)

    return map_arrow(kept.select("lang", "sources", "n"), work, schema)


def price(level: int, total: int, terms: int) -> int:
    """The probability of a term of this count as an integer, from all counts and kept terms."""
    return 1 + SCALE * (level + SMOOTH) // (total + SMOOTH * terms)


class Levels:
    """The indicator columns of one block, source by source, in runs of at most COLUMNS."""

    def __init__(self, row: np.ndarray, source: np.ndarray, n: np.ndarray, totals: list[int], terms: int):
        self.height = int(row.max()) + 1
        order = np.argsort(source, kind="stable")
        self.row, self.n = row[order], n[order]
        self.first = np.searchsorted(source[order], np.arange(len(totals) + 1))
        self.totals, self.terms = totals, terms

    def column_blocks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """First source, matrix, prices of its columns, and where each source's columns begin."""
        start = width = 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for s, total in enumerate(self.totals):
            count = np.zeros(self.height, np.int64)
            at = slice(self.first[s], self.first[s + 1])
            count[self.row[at]] = self.n[at]
            levels, column = np.unique(count, return_inverse=True)
            if held and width + len(levels) > COLUMNS:
                yield self._matrix(start, held)
                start, width, held = s, 0, []
            prices = [price(x, total, self.terms) for x in levels.tolist()]
            held.append((column, np.array(prices, np.int64)))
            width += len(levels)
        if held:
            yield self._matrix(start, held)

    def _matrix(self, start: int, held: list) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        sizes = [len(p) for _, p in held]
        begin = np.cumsum([0, *sizes[:-1]])
        ones = np.zeros((self.height, sum(sizes)), np.float32)
        for b, (column, _) in zip(begin.tolist(), held, strict=True):
            ones[np.arange(self.height), b + column] = 1
        return start, ones, np.concatenate([p for _, p in held]), begin


def _priced(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of two sources and the distance between them over the block's terms."""
    (at_a, ones_a, prices_a, begin_a), (at_b, ones_b, prices_b, begin_b) = a, b
    joint = (ones_a.T @ ones_b).astype(np.int64)  # every joint table of the two runs of sources
    joint *= np.abs(prices_a[:, None] - prices_b[None, :])
    sums = np.add.reduceat(np.add.reduceat(joint, begin_a, axis=0), begin_b, axis=1)
    i, j = np.nonzero(np.ones_like(sums))
    later = at_a + i < at_b + j
    return (at_a + i)[later], (at_b + j)[later], sums[i, j][later]


def distances(blocks: DataFrame) -> DataFrame:
    """lang, the numbers of two of its sources (a < b) and their summed distance, of blocks with
    their language's `totals` and number of `terms`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, source, n = (
                    batch.column(c)[i].values.to_numpy() for c in ("row", "source", "n")
                )
                totals, terms = batch.column("totals")[i].as_py(), batch.column("terms")[i].as_py()
                levels = Levels(row, source, n, totals, terms)
                for a in levels.column_blocks():
                    for b in levels.column_blocks():
                        if b[0] >= a[0]:
                            one, other, value = _priced(a, b)
                            yield pa.RecordBatch.from_pydict({
                                "lang": pa.array([batch.column("lang")[i].as_py()] * len(one), pa.string()),
                                "a": pa.array(one, pa.int32()),
                                "b": pa.array(other, pa.int32()),
                                "value": pa.array(value, pa.int64()),
                            })

    each = map_arrow(blocks, work, "lang string, a int, b int, value long")
    return each.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _p(n: str, total: str) -> str:
    """The price as Spark computes it, exact in decimals."""
    return (
        f"1L + cast({SCALE} as decimal(10,0)) * cast({n} + {SMOOTH} as decimal(20,0))"
        f" div cast({total} + {SMOOTH} * terms as decimal(20,0))"
    )


def audit(docs: DataFrame, documents: int = DOCUMENTS, listed: int = TERMS) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value and rank."""
    every = written(counts(docs), "term-counts")
    groups = every.where("term is null").select("lang", "source")
    numbered = groups.groupBy("lang").agg(F.sort_array(F.collect_list("source")).alias("names"))
    numbered = written(numbered, "sources")
    # Each kept term with its counts, one a source of the language at most.
    kept = (
        every.where("term is not null")
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("held"))
        .where(F.col("docs") >= documents)
        .join(numbered, "lang")
        .selectExpr(
            "lang",
            "term",
            "transform(held, x -> cast(array_position(names, x.source) - 1 as int)) as sources",
            "held.n as n",
            "aggregate(held.n, 0L, (s, x) -> s + x) as all_n",
        )
    )
    kept = written(kept, "kept-terms")
    each = kept.select("lang", F.explode(F.arrays_zip("sources", "n")).alias("x"))
    totals = each.groupBy("lang", "x.sources").agg(F.sum("x.n").alias("total"))
    # One row a language: its terms, all counts, and the totals of its sources in their order.
    of_lang = (
        numbered.join(totals.groupBy("lang").agg(
            F.map_from_entries(F.collect_list(F.struct("sources", "total"))).alias("by_source")
        ), "lang", "left")
        .join(kept.groupBy("lang").agg(F.count("*").alias("terms")), "lang", "left")
        .selectExpr(
            "lang",
            "names",
            "coalesce(terms, 0L) as terms",
            "transform(names, (x, i) -> coalesce(by_source[i], 0L)) as totals",
        )
        .selectExpr("*", "aggregate(totals, 0L, (s, x) -> s + x) as all_total")
    )
    of_lang = written(of_lang, "languages")

    blocks = written(_blocks(kept), "term-blocks")
    apart = distances(blocks.join(of_lang.select("lang", "terms", "totals"), "lang"))
    apart = written(apart, "distances")
    both = apart.union(apart.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = (
        of_lang.select("lang", "names", F.posexplode("names").alias("a", "source"))
        .select("lang", "source", "a", F.posexplode("names").alias("b", "item"))
        .where("a <> b")
        .join(both, ["lang", "a", "b"], "left")
        .select(
            "lang", "source", F.lit("pair").alias("part"), "item",
            F.coalesce("value", F.lit(0)).cast("long").alias("value"),
        )
    )
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(group))
    terms = (
        kept.join(of_lang, "lang")
        .select("*", F.explode(F.arrays_zip(F.col("sources").alias("at"), F.col("n").alias("count"))).alias("x"))
        .where("x.count > 0")
        .selectExpr(
            "lang",
            "names[x.at] as source",
            "'term' as part",
            "term as item",
            f"({_p('x.count', 'totals[x.at]')}) - ({_p('all_n', 'all_total')}) as value",
        )
        .where("value > 0")
        .withColumn("rank", F.row_number().over(group))
        .where(F.col("rank") <= listed)
    )
    return pairs.unionByName(terms)


def op13(docs: DataFrame) -> DataFrame:
    return audit(docs)


OP13_SQL = f"""
with docs as (
    select row_number() over () as uid, coalesce(lang, '') as lang, coalesce(source, '') as source,
        coalesce(text, '') as text
    from documents),
words as (
    select uid, lang, source,
        unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from docs),
kept as (
    select lang, term from words group by lang, term having count(distinct uid) >= {DOCUMENTS}),
n_terms as (select lang, count(*) as v from kept group by lang),
found as (
    select w.lang, w.source, w.term, count(*) as n
    from words w join kept k on w.lang = k.lang and w.term = k.term
    group by w.lang, w.source, w.term),
groups as (select distinct lang, source from docs),
sized as (
    select g.lang, g.source, coalesce(v, 0) as v,
        coalesce((select sum(n) from found f where f.lang = g.lang and f.source = g.source), 0) as total
    from groups g left join n_terms using (lang)),
level as (
    select s.lang, s.source, k.term, coalesce(f.n, 0) as n,
        1 + {SCALE}::hugeint * (coalesce(f.n, 0) + {SMOOTH}) // (s.total + {SMOOTH} * s.v) as p
    from sized s join kept k on k.lang = s.lang
    left join found f on f.lang = s.lang and f.source = s.source and f.term = k.term),
whole as (
    select l.lang, l.term,
        1 + {SCALE}::hugeint * (sum(l.n) + {SMOOTH}) // (any_value(t.total) + {SMOOTH} * any_value(t.v)) as q
    from level l
    join (select lang, sum(total) as total, any_value(v) as v from sized group by lang) t
        on t.lang = l.lang
    group by l.lang, l.term),
apart as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from level a join level b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by a.lang, a.source, b.source),
pairs as (
    select a.lang, a.source, 'pair' as part, b.source as item,
        cast(coalesce(p.value, 0) as bigint) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join apart p on p.lang = a.lang and p.source = a.source and p.item = b.source),
terms as (
    select l.lang, l.source, 'term' as part, l.term as item, cast(l.p - w.q as bigint) as value
    from level l join whole w on w.lang = l.lang and w.term = l.term
    where l.n > 0 and l.p > w.q),
ranked as (
    select *, cast(row_number() over (
        partition by lang, source, part order by value desc, item) as int) as rank
    from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= {TERMS}
"""
