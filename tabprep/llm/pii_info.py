"""Information-theoretic sanitisation of personal data.

*Base spans* are found by pattern and checked by rule (IP parts, Luhn digits,
phone length).  Their values are the protected entities.

*Disclosure.*  Over all documents, N in number, an entity e carries
``IC(e) = log2(N / df(e))`` bits, and a term t reveals
``PMI(t, e) = log2(p(e | t) / p(e))`` of them, with ``p(e) = df(e) / N`` and
``p(e | t) = (df(t, e) + p(e)) / (df(t) + 1)``, from document frequencies and
document co-occurrences of the whole corpus.  The estimate adds to each term one
document that holds e as often as any: a rare term says less than a frequent one
of the same ratio, but every entity and pair is judged.  A term whose share
``PMI / IC`` reaches ``generalise_at`` gives the entity away: in documents that
hold the entity it becomes a span too, ``remove_at`` or more removes it and less
generalises it.  (A term of one document, that of its entity, reaches 0.9 in
corpora of about a thousand documents or more.)

Only entities, pairs and term frequencies are shuffled, partially aggregated;
whole texts are shuffled for documents that hold an entity, never for others.
What gives an entity away stays in rows ``entity, term``; those of the documents'
own pairs that a bit set of them lets pass are joined to them, and a document gathers its own hits only, at most its
distinct words.  The few entities of many documents are dealt over ``SALTS``
keys in each join.

Main path: DataFrame operations only.

Defined results: a null text is empty; positions count code points, ends are
exclusive; added spans never overlap base spans; rows with a null id are
handled like others; repeated rows repeat; an empty table gives an empty
result; other columns pass through ``annotate`` and ``sanitise``, and columns
named like the new ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import perhaps_in, with_row, let, require, stage

#: Kinds of base spans in the order of ties, and the kind of added spans.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# Possessive forms of the contract's patterns: they match the same spans, but
# never go back over a long run.  A match starts where a run starts or where the
# last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that a text can hold the kind at all.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

GENERALISE_AT = 0.9
REMOVE_AT = 0.98
#: An entity with more than this share of all mentions is dealt over so many
#: keys; at most ``1 / HOT`` entities have it.
HOT = 0.01
SALTS = 64
#: Code points that a term has at least.
LEAST_CHARS = 3
#: Characters that separate terms besides white space, and the case folding.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAK = "\t\n\x0b\f\r.,;:!?()[]{}<>\"'`|*#&%$@/\\=+"


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.cast("double") <= 255)
    if kind == "card":
        n = F.length(digits)
        doubled = F.transform(F.sequence(F.lit(1), n), lambda k: F.when(
            F.pmod(n - k, F.lit(2)) == 1, F.substring(digits, k, F.lit(1)).cast("int") * 2).otherwise(F.substring(digits, k, F.lit(1)).cast("int")))
        total = F.aggregate(doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))
        return F.when(n.between(14, 19), F.pmod(total, F.lit(10)) == 0).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _found(kind: str, text: Column) -> Column:
    """Spans of one kind: array of (start, kind number, end, value), in order.

    Starts follow from the lengths of the pieces between the matches."""
    matches = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    pieces = F.split(text, PATTERNS[kind], -1)
    number = KINDS.index(kind)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    first = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["piece"])
        end = start + F.length(pair["match"])
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"), pair["match"].alias("value"))
        return F.struct(end.alias("at"), F.when(_valid(kind, pair["match"]), F.concat(state["out"], F.array(span)))
                        .otherwise(state["out"]).alias("out"))

    pairs = F.zip_with(matches, F.slice(pieces, 1, F.size(matches)), lambda m, p: F.struct(m.alias("match"), p.alias("piece")))
    spans = F.aggregate(pairs, first, add, lambda s: s["out"])
    possible = F.contains(text, F.lit(HINTS[kind])) if HINTS[kind] else F.lit(True)
    return F.when(possible & F.rlike(text, F.lit(PATTERNS[kind])), spans).otherwise(none)


def with_base(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``_text`` (never null), ``_base`` (spans by start, then kind)
    and ``_entities`` (distinct values, digits only for cards and phones)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    value = lambda s: F.concat(
        F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), F.lit(":"),
        F.when(s["kind"] >= KINDS.index("card"), F.regexp_replace(s["value"], "[^0-9]", "")).otherwise(F.lower(s["value"])))
    spans = lambda t: F.array_sort(F.concat(*[_found(k, t) for k in KINDS]))
    both = let(text, lambda t: let(spans(t), lambda b: F.struct(
        b.alias("base"), F.array_distinct(F.transform(b, value)).alias("entities"))))
    found = df.withColumn("_text", text).withColumn("_found", both)
    return found.select("*", F.col("_found.base").alias("_base"), F.col("_found.entities").alias("_entities")).drop("_found")


def terms(text: Column) -> Column:
    """The text cut into terms; each separator is one character, so positions
    are sums of lengths.  Empty strings stand between separators."""
    return F.split(F.translate(text, _UPPER + _BREAK, _UPPER.lower() + " " * len(_BREAK)), " ", -1)


def _words(text: Column) -> Column:
    """Distinct terms of a text."""
    return F.array_distinct(F.filter(terms(text), lambda w: F.length(w) >= LEAST_CHARS))


def _key(id_col: str) -> list[Column]:
    """What tells texts apart; needs ``_text``."""
    return [F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_id"), F.xxhash64("_text").alias("_hash")]


def _hot(common: DataFrame) -> list[str]:
    """The entities with more than ``HOT`` of all mentions, at most ``1 / HOT``."""
    total = common.agg(F.sum("df_e")).first()[0] or 0
    return [r.entity for r in common.where(F.col("df_e") > HOT * total).select("entity").collect()]


def _dealt(rows: DataFrame, hot: list[str], by: list[str]) -> DataFrame:
    """``rows`` with ``_salt``: those of a hot entity spread by ``by``."""
    return rows.withColumn("_salt", F.when(F.col("entity").isin(hot), F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))


def _copied(rows: DataFrame, hot: list[str]) -> DataFrame:
    """``rows`` with ``_salt``: those of a hot entity once for each value."""
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    return rows.withColumn("_salt", F.explode(F.when(F.col("entity").isin(hot), every).otherwise(F.array(F.lit(0)))))


def _pairs(holders: DataFrame, *keep: str) -> DataFrame:
    """``entity, term`` of each row: every entity with every distinct word."""
    return holders.select(*keep, F.explode("_entities").alias("entity"), "_words").select(*keep, "entity", F.explode("_words").alias("term"))


def disclosing(df: DataFrame, text_col: str = "text", generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT,
               id_col: str = "doc_id") -> tuple[DataFrame, DataFrame, list[str]]:
    """``entity, term, share, removed`` of every pair that gives an entity away,
    the documents that hold entities (``_id, _hash, _entities, _words``) and
    the hot entities."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = with_base(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))).where(F.size("_entities") > 0)
    holders = stage(rows.select(*_key("id"), "_entities", _words(F.col("_text")).alias("_words")))
    n = df.count()
    common = stage(holders.select(F.explode("_entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("df_e")))
    hot = _hot(common)
    pairs = _pairs(holders).groupBy("entity", "term").agg(F.count("*").alias("df_te"))
    every = df.select(F.explode(_words(text)).alias("term")).groupBy("term").agg(F.count("*").alias("df_t"))
    joined = _dealt(pairs, hot, ["term"]).join(_copied(common, hot), ["entity", "_salt"]).join(every, "term")
    # PMI / IC, with log2(N / df(e)) in both; an entity in every document carries no information
    ic = F.log2(F.lit(float(n)) / F.col("df_e"))
    given = (F.col("df_te") + F.col("df_e") / F.lit(float(n))) / (F.col("df_t") + 1)
    share = F.when(ic > 0, 1 + F.log2(given) / ic).otherwise(F.lit(0.0))
    found = joined.select("entity", "term", share.alias("share")).where(F.col("share") >= generalise_at).withColumn(
        "removed", F.col("share") >= remove_at)
    return found, holders, hot


def annotate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise_at: float = GENERALISE_AT,
             remove_at: float = REMOVE_AT) -> DataFrame:
    """``df`` with ``_text``, ``_base`` and ``_added``: spans (start, kind, end,
    removed) of the terms that give away an entity of the same text."""
    require(df, [id_col, text_col])
    found, holders, hot = disclosing(df, text_col, generalise_at, remove_at, id_col)
    found = stage(found.select("entity", "term", "removed"))
    rows = with_base(df, text_col)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,removed:boolean>>")
    plain = rows.where(F.size("_entities") == 0).withColumn("_added", none).drop("_entities")
    own = _pairs(holders, "_id", "_hash").where(perhaps_in(found, "entity", "term")).distinct()
    own = _dealt(own, hot, ["_id", "_hash"])
    given = own.join(_copied(found, hot), ["entity", "_salt", "term"]).groupBy("_id", "_hash").agg(
        F.collect_set(F.struct("term", "removed")).alias("_terms"))
    some = rows.where(F.size("_entities") > 0).select("*", *_key(id_col))
    some = some.join(given, ["_id", "_hash"], "left").drop("_id", "_hash", "_entities")
    named = lambda t: F.array_distinct(F.transform(t, lambda x: x["term"]))
    gone = lambda t: F.transform(F.filter(t, lambda x: x["removed"]), lambda x: x["term"])
    spans = let(named(F.col("_terms")), lambda n: let(gone(F.col("_terms")), lambda g: _term_spans(F.col("_text"), F.col("_base"), n, g)))
    some = some.withColumn("_added", F.when(F.col("_terms").isNull(), none).otherwise(spans)).drop("_terms")
    return plain.unionByName(some)


def _term_spans(text: Column, base: Column, names: Column, gone: Column) -> Column:
    """Spans of the words among ``names`` that touch no base span."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int,removed:boolean>>")
    first = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def add(state: Column, word: Column) -> Column:
        end = state["at"] + F.length(word)
        free = ~F.exists(base, lambda b: (b["start"] < end) & (b["end"] > state["at"]))
        span = F.struct(state["at"].alias("start"), F.lit(len(KINDS)).alias("kind"), end.alias("end"),
                        F.array_contains(gone, word).alias("removed"))
        hit = (F.length(word) >= LEAST_CHARS) & F.array_contains(names, word)
        out = F.when(hit, F.when(free, F.concat(state["out"], F.array(span))).otherwise(state["out"])).otherwise(state["out"])
        return F.struct((end + 1).alias("at"), out.alias("out"))

    return F.aggregate(terms(text), first, add, lambda s: s["out"])


def _named(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*map(F.lit, (*KINDS, TERM)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _plain(spans: Column, removed: bool) -> Column:
    """Spans without their value, for merging base and added ones."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                                                 (s["removed"] if removed else F.lit(False)).alias("removed")))


def _all_spans() -> Column:
    return F.array_sort(F.concat(_plain(F.col("_base"), False), _plain(F.col("_added"), True)))


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds: float) -> DataFrame:
    """Counts by base kind, the base spans' digest and all spans, per row."""
    rows = annotate(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), **thresholds)
    def count(number: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(_named(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
                       _named(_all_spans()).alias("spans"), F.size("_added").cast("long").alias("n_term"))


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars",
             **thresholds: float) -> DataFrame:
    """``df`` with personal data replaced: base spans by their kind in square
    brackets, generalised terms by ``[TERM]``, removed terms by nothing.  A
    length column of that name is brought up to date."""
    rows = annotate(with_row(df, doc_id=F.col(f"`{id_col}`"), text=F.col(f"`{text_col}`")), "doc_id", "text", **thresholds)
    text = F.col("_text")
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in (*KINDS, TERM)])
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(state: Column, span: Column) -> Column:
        mark = F.when(span["removed"], F.lit("")).otherwise(F.element_at(labels, span["kind"] + 1))
        fresh = F.concat(state["out"], F.substring(text, state["at"] + 1, span["start"] - state["at"]), mark)
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"),
                        F.when(span["start"] >= state["at"], fresh).otherwise(state["out"]).alias("out"))

    whole = F.aggregate(_all_spans(), first, add, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    touched = (F.size("_base") > 0) | (F.size("_added") > 0)
    out = rows.withColumns({"_fresh": F.when(touched, whole).otherwise(F.col("text")), "_touched": touched})

    def kept(name: str) -> Column:
        old = F.col("row").getField(name)
        if name == text_col:
            return F.col("_fresh").alias(name)
        if name == length_col:
            return F.when(F.col("_touched"), F.length("_fresh").cast(df.schema[name].dataType)).otherwise(old).alias(name)
        return old.alias(name)

    return out.select(*map(kept, df.columns))
