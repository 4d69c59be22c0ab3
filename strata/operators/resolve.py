"""Entity resolution against a master (ER-01..05, JON-10).

Both matchers are filtered joins: equi-joins on parts of the strings give candidate pairs, none that
can reach the threshold is lost, and only candidates are scored (Arrow-batched).

ER-01, token-set score >= t. Tokens are ordered by how many names hold them, the rarest first. A pair can
reach t in three ways, and each has its own index (``candidate_pairs``):
  * the master name's tokens are in the query's but for a rest too short to matter (none, in the
    subset case): its *prefix*, the rarest tokens whose joined length exceeds the longest such rest, has a
    token in the query, so only prefixes are indexed and a token that all names hold is looked up by
    none but the names that have no rarer one;
  * the same with the sides exchanged;
  * what the two have besides their common tokens is similar: at most k insertions and deletions lie between,
    so of any k + 1 disjoint pieces of the name's rarest tokens one stands verbatim in a token of the query.
    Of short names (k = 1) all pieces may be in all names; there one token of the two differs by a letter or
    is written as two, and all others are common: those are looked up with the token as it may differ.
Tokens that very many queries hold are split by a salt.

ER-04, best mean of two partial ratios >= r. One of the two names must reach r itself against a window
of the text, so of its k + 1 pieces one stands verbatim in the text (``similar_parts``). Pairs of name parts that
both reach r are looked up in the master by equality; texts whose best mean may still lie elsewhere take the
master rows of the parts that they have, with the other name scored (``identify``)."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.clean import ACCENTED, PLAIN, fold_text
from ..functions.core import c
from ..functions.similarity import partial_ratio, partial_ratio_upper_bound, token_set_ratio

#: Queries that hold a token, for each salt of it.
SPLIT_ROWS = 50_000


@F.pandas_udf(DoubleType())
def token_set_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def partial_score(least: float):
    """Partial ratio of a name in a text; 0 where the characters in common rule out ``least``."""

    @F.pandas_udf(DoubleType())
    def score(name: pd.Series, text: pd.Series) -> pd.Series:
        counts: dict[str, Counter] = {}

        def one(n: str, t: str) -> float:
            for x in (n, t):
                if x not in counts:
                    counts[x] = Counter(x)
            if partial_ratio_upper_bound(counts[n], len(n), counts[t], len(t)) < least:
                return 0.0
            return partial_ratio(n, t)

        return pd.Series([one(n, t) for n, t in zip(name, text)], dtype="float64")

    return score


def prepare_master(df: DataFrame, name_cols: list[str], value_col: str, exclude_regex: str | None = None,
                   order_col: str | None = None) -> DataFrame:
    """ER-03: (name, value) dictionary. Names are the folded concatenation of
    ``name_cols``; rows matching ``exclude_regex`` (non-human names) are removed;
    a blank value is NULL and dropped; duplicated names keep the last row
    (by ``order_col``, else the largest value)."""
    raw = F.concat_ws(" ", *[F.coalesce(c(n).cast("string"), F.lit("")) for n in name_cols])
    d = df.select(raw.alias("__raw"), F.nullif(F.trim(c(value_col).cast("string")), F.lit("")).alias("value"),
                  *( [c(order_col).alias("__o")] if order_col else []))
    if exclude_regex:
        d = d.filter(~F.coalesce(d["__raw"].rlike("(?i)" + exclude_regex), F.lit(False)))
    d = d.withColumn("name", fold_text("__raw")).filter(F.col("value").isNotNull() & (F.col("name") != ""))
    if order_col:
        w = Window.partitionBy("name").orderBy(F.col("__o").desc_nulls_last(), F.col("value").desc())
        d = d.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
        return d.select("name", "value")
    return d.groupBy("name").agg(F.max("value").alias("value"))


def _by_rarity(queries: DataFrame, master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(q, tokens), (name, tokens): the distinct tokens of each as structs (n, tok, salts), rarest first, where n
    is in how many queries and names a token is and salts in how many parts its queries are split."""
    def tokens(df, own, side):
        return df.select(F.lit(side).alias("side"), F.col(own).alias("s"), F.explode(F.array_distinct(F.split(own, " "))).alias("tok")).filter("tok != ''")

    both = tokens(queries, "q", 0).unionByName(tokens(master, "name", 1))
    held = both.groupBy("tok").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("side") == 0, 1).otherwise(0)).alias("nq"))
    held = held.select("tok", "n", F.greatest(F.ceil(F.col("nq") / SPLIT_ROWS), F.lit(1)).cast("int").alias("salts"))
    lists = both.join(held, "tok").groupBy("side", "s").agg(F.array_sort(F.collect_list(F.struct("n", "tok", "salts"))).alias("tokens"))
    return (lists.filter("side = 0").select(F.col("s").alias("q"), "tokens"), lists.filter("side = 1").select(F.col("s").alias("name"), "tokens"))


def _rest(frac: float) -> Column:
    """The longest rest beside the common tokens with which these alone reach the threshold, given the length of
    all tokens joined: (1 + x) / (2 * length - 1 - x) <= frac."""
    return (F.lit(frac) * (2 * F.col("len") - 1) - 1) / F.lit(1 + frac) + F.lit(1e-9)


def _prefix(frac: float) -> Column:
    """The tokens, rarest first, before which no more is joined than such a rest."""
    def before(i):
        return F.length(F.array_join(F.transform(F.slice("tokens", 1, i), lambda t: t["tok"]), " "))

    return F.filter("tokens", lambda t, i: (i == 0) | (before(i) <= _rest(frac)))


def _pieces(size: int) -> Column:
    """Disjoint pieces of so many letters from each token, rarest tokens first."""
    def of(t):
        n = F.floor(F.length(t["tok"]) / size).cast("int")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.substring(t["tok"], i * size + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.transform("tokens", of)))


PIECE_SIZES = (4, 3, 2, 1)


def _with_one_token(df: DataFrame, key: str, whole: str, changed: str) -> DataFrame:
    """(key, len, sig): the other tokens and one, as it is (tagged ``whole``), and (tagged ``changed``) without
    one of its letters or with a second token put to its end. The longer of two strings that are an insertion
    apart is the shorter one so changed."""
    rows = df.withColumn("toks", F.array_sort(F.transform("tokens", lambda t: t["tok"])))

    def sig(tag, token, *left_out):
        def others(_, at):
            keep = F.lit(True)
            for i in left_out:
                keep = keep & (at != i)
            return keep
        return F.concat(F.lit(tag + "|"), F.array_join(F.filter("toks", others), " "), F.lit("|"), token)

    asis = F.transform("toks", lambda t, i: sig(whole, t, i))
    shorter = F.flatten(F.transform("toks", lambda t, i: F.transform(
        F.sequence(F.lit(1), F.length(t)), lambda p: sig(changed, F.concat(F.substring(t, F.lit(1), p - 1), F.substring(t, p + 1, F.length(t))), i))))
    joined = F.flatten(F.transform("toks", lambda t, i: F.transform(
        F.filter(F.sequence(F.lit(0), F.size("toks") - 1), lambda j: j > i), lambda j: sig(changed, F.concat(t, F.get("toks", j)), i, j))))
    return rows.select(key, "len", F.explode(F.array_distinct(F.concat(asis, shorter, joined))).alias("sig"))


def candidate_pairs(queries: DataFrame, master: DataFrame, threshold: float = 95.0) -> DataFrame:
    """Candidates for token-set similarity >= threshold, none lost (see the module's text).
    ``queries``: (q); ``master``: (name); both distinct. Returns distinct (q, name)."""
    frac = 1.0 - threshold / 100.0
    hi = (1 + frac) / (1 - frac)  # max length ratio allowed by the threshold
    joined = F.length(F.array_join(F.transform("tokens", lambda t: t["tok"]), " "))
    qs, ms = (x.withColumn("len", joined) for x in _by_rarity(queries, master))

    def probe(df, key):
        return df.select(key, "len", F.explode("tokens").alias("t")).select(key, "len", "t.tok", "t.salts", F.pmod(F.xxhash64(key), F.col("t.salts")).cast("int").alias("salt"))

    def index(df, key):
        rows = df.select(key, F.explode(_prefix(frac)).alias("t"))
        return rows.select(key, "t.tok", F.explode(F.sequence(F.lit(0), F.col("t.salts") - 1)).alias("salt"))

    in_query = probe(qs, "q").join(index(ms, "name"), ["tok", "salt"]).select("q", "name")
    in_name = qs.select("q", F.explode(_prefix(frac)).alias("t")).select("q", "t.tok", F.pmod(F.xxhash64("q"), F.col("t.salts")).cast("int").alias("salt"))
    tokens = ms.select("name", F.explode("tokens").alias("t")).select("name", "t.tok", F.explode(F.sequence(F.lit(0), F.col("t.salts") - 1)).alias("salt"))
    in_name = in_name.join(tokens, ["tok", "salt"]).select("q", "name")

    k = F.floor(F.lit(frac) * (F.col("len") + F.col("len") * F.lit(hi)) + F.lit(1e-9)).cast("int")
    if frac > 0:
        # names that one insertion or deletion at most may change, and the queries that are not too long for these
        near = ms.filter(k == 1)
        brief = qs.filter(F.col("len") <= 2 * hi / (frac * (1 + hi)) + 1e-9)
        one_edit = _with_one_token(brief, "q", "q", "m").join(_with_one_token(near, "name", "m", "q").withColumnRenamed("len", "mlen"), "sig")
    else:
        one_edit = None
    cut = ms.filter(k > 1).select("name", "len", (k + 1).alias("want"), *[_pieces(n).alias(f"p{n}") for n in PIECE_SIZES])
    # the longest pieces of which there are enough; with fewer letters than that (low thresholds) all of them:
    # any score above 0 needs one in common
    chosen = F.coalesce(*[F.when(F.size(f"p{n}") >= F.col("want"), F.slice(f"p{n}", 1, F.col("want"))) for n in PIECE_SIZES], F.col("p1"))
    pieces = cut.select("name", F.col("len").alias("mlen"), F.explode(chosen).alias("piece"))
    sizes = F.array(*[F.lit(n) for n in PIECE_SIZES])
    words = qs.select("q", "len", F.explode("tokens.tok").alias("tok")).select("q", "len", "tok", F.explode(sizes).alias("size")).filter(F.length("tok") >= F.col("size"))
    parts = words.select("q", "len", F.explode(F.transform(F.sequence(F.lit(1), F.length("tok") - F.col("size") + 1), lambda i: F.substring(F.col("tok"), i, F.col("size")))).alias("piece")).distinct()
    similar = parts.join(pieces, "piece").select("q", "name", "len", "mlen")
    if one_edit is not None:
        similar = similar.unionByName(one_edit.select("q", "name", "len", "mlen"))
    similar = similar.filter(F.least("len", "mlen") * F.lit(hi) + F.lit(1e-9) >= F.greatest("len", "mlen")).select("q", "name")
    return in_query.unionByName(in_name).unionByName(similar).distinct()


def fuzzy_lookup(names: DataFrame, name_col: str, master: DataFrame, threshold: float = 95.0,
                 min_len: int = 3, out: str = "match_value") -> DataFrame:
    """ER-01: distinct folded names -> best master value with token-set score >=
    threshold; best = (score, master name length, master name) descending/desc/asc
    over ALL qualifying candidates (D-21). Returns (q, match_name, score, value)."""
    q = names.select(fold_text(c(name_col)).alias("q")).filter(F.length("q") >= min_len).distinct()
    m = master.select("name", "value")
    pairs = candidate_pairs(q, m.select("name").distinct(), threshold)
    scored = (pairs.withColumn("score", token_set_score("q", "name")).filter(F.col("score") >= threshold)
              .join(m, "name"))
    w = Window.partitionBy("q").orderBy(F.col("score").desc(), F.length("name").desc(), F.col("name").asc())
    best = scored.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    return best.select("q", F.col("name").alias("match_name"), "score", F.col("value").alias(out))


def resolve_with_fallback(df: DataFrame, name_col: str, masters: list[DataFrame], keyword_rules: list[tuple[list[str], str]],
                          original_col: str, out: str, threshold: float = 95.0) -> DataFrame:
    """ER-02: first master match, then the second master, then keyword rules
    (contains-any on the upper-cased folded name), else the original value.
    A blank matched value never stops the chain (D-22)."""
    q = fold_text(c(name_col))
    res = df.withColumn("__q", q)
    chain = []
    for i, m in enumerate(masters):
        look = fuzzy_lookup(df, name_col, m, threshold, out=f"__v{i}").select(F.col("q").alias("__q"), f"__v{i}")
        res = res.join(look, "__q", "left")
        chain.append(F.nullif(F.trim(F.col(f"__v{i}")), F.lit("")))
    kw = None
    up = F.upper(F.col("__q"))
    for words, label in keyword_rules:
        cond = F.lit(False)
        for w_ in words:
            cond = cond | up.contains(w_.upper())
        kw = F.when(cond, F.lit(label)) if kw is None else kw.when(cond, F.lit(label))
    if kw is not None:
        chain.append(kw)
    chain.append(c(original_col))
    return res.withColumn(out, F.coalesce(*chain)).drop("__q", *[f"__v{i}" for i in range(len(masters))])


IDENTIFY_SCHEMA = ("texto string, nombre_detectado string, Estado string, oficina_comercial string, "
                   "tipo_coincidencia string, fuzzy_score_nombre double, fuzzy_score_apellido double, "
                   "fuzzy_score_combinado double")


def edits_within(n: int, least: float) -> int:
    """Most insertions and deletions between a string of n letters and a window of at most n letters whose ratio
    is ``least`` or more: with a window of w letters they are at least n - w, and n + w and their number are even or
    odd together."""
    most = -1
    for w in range(1, n + 1):
        k = math.floor((1 - least / 100) * (n + w) + 1e-9)
        k -= (k - n - w) % 2
        if k >= n - w:
            most = max(most, k)
    return most


def _cuts(least: float, longest: int) -> Column:
    """For each length up to ``longest`` (a few hundred): (piece number, start, letters) of its pieces."""
    def pieces(n):
        parts = min(edits_within(n, least) + 1, n)
        at = [i * n // parts for i in range(parts + 1)]
        return F.array(*[F.struct(F.lit(x + 1).alias("start"), F.lit(y - x).alias("size")) for x, y in zip(at, at[1:])])

    return F.array(*[pieces(n) for n in range(1, longest + 1)])


#: Letters of a name (or of a text that is shorter than the name) up to which pieces are cut by length; of a longer
#: string the first so many letters are cut into the pieces that its edits ask for.
LONGEST_CUT = 64


def _pieces_of(df: DataFrame, col: str, least: float) -> DataFrame:
    """The rows, once for each piece of the string: as many pieces as edits are allowed, and one more."""
    return df.withColumn("__p", F.explode(F.element_at(_cuts(least, LONGEST_CUT), F.length(col)))).withColumn(
        "piece", F.substring(F.col(col), F.col("__p.start"), F.col("__p.size"))).drop("__p")


def _substrings_of(df: DataFrame, col: str, least: float) -> DataFrame:
    """The rows, once for each distinct substring that may be a piece of another string."""
    sizes = sorted({(i + 1) * n // p - i * n // p for n in range(1, LONGEST_CUT + 1) for p in [min(edits_within(n, least) + 1, n)] for i in range(p)})
    rows = df.withColumn("__n", F.explode(F.array(*[F.lit(x) for x in sizes]))).filter(F.length(col) >= F.col("__n"))
    every = F.transform(F.sequence(F.lit(1), F.length(col) - F.col("__n") + 1), lambda i: F.substring(F.col(col), i, F.col("__n")))
    return rows.withColumn("piece", F.explode(F.array_distinct(every))).drop("__n")


def similar_parts(texts: DataFrame, parts: DataFrame, least: float) -> DataFrame:
    """(low, part, score): the pairs of a text (low) and a name part (part), both distinct, whose partial ratio is
    ``least`` or more. The shorter string has a piece that stands verbatim in the longer one; of strings of the same
    length either may be the one whose window is taken."""
    long_text = F.length("part") <= F.length("low")
    short = parts.filter(F.length("part").between(1, LONGEST_CUT))
    in_text = _substrings_of(texts, "low", least).join(_pieces_of(short, "part", least), "piece").filter(long_text)
    brief = texts.filter(F.length("low").between(1, LONGEST_CUT))
    in_part = _pieces_of(brief, "low", least).join(_substrings_of(parts, "part", least), "piece").filter(F.length("part") >= F.length("low"))
    pairs = in_text.select("low", "part").unionByName(in_part.select("low", "part"))
    # strings of more letters than pieces are cut for: as they are, or by their first letters
    beyond = _long_pairs(texts, parts, least)
    return pairs.unionByName(beyond).distinct().withColumn("score", partial_score(least)("part", "low")).filter(F.col("score") >= least)


def _long_pairs(texts: DataFrame, parts: DataFrame, least: float) -> DataFrame:
    """Pairs of which the shorter string has over LONGEST_CUT letters: cut into pieces of the size that its own number of
    edits leaves, which is the same for all of them but for the remainder."""
    size = max(1, math.floor(1 / (2 * (1 - least / 100) + 2 / LONGEST_CUT)))

    def fixed(df, col, step):
        every = F.transform(F.sequence(F.lit(1), F.length(col) - size + 1, F.lit(step)), lambda i: F.substring(F.col(col), i, F.lit(size)))
        return df.filter(F.length(col) > LONGEST_CUT).withColumn("piece", F.explode(F.array_distinct(every)))

    in_text = fixed(texts, "low", 1).join(fixed(parts, "part", size), "piece").filter(F.length("part") <= F.length("low"))
    in_part = fixed(texts, "low", size).join(fixed(parts, "part", 1), "piece").filter(F.length("part") >= F.length("low"))
    return in_text.select("low", "part").unionByName(in_part.select("low", "part"))


def identify(texts: DataFrame, text_col: str, master: DataFrame, accept: float = 90.0, review: float = 86.0,
             generic_regex: str = r"\b(?:ventas|ventas calle|agente)\b", office_regex: str = r"ofi\w*\s*(.*)") -> DataFrame:
    """ER-04: identify a seller in free text against a (first name, last name,
    state, office) master. Exact substring of the full name -> ``Exacta`` 100;
    else best mean of partial ratios of first/last name: >= accept ``Fuzzy``,
    >= review ``Pendiente de Revisión``; else an office marker -> ``Oficina
    Detectada`` with the text after it; else ``No detectado``. Generic words
    short-circuit to ``No detectado``.

    A filtered join: name parts that reach ``review`` in a text by themselves come from ``similar_parts``; a mean of
    ``review`` needs one of them. Of equal means the first row in (name, surname, state, office) counts. A NULL text
    is the text ``none``, as its string is."""
    distinct = texts.select(c(text_col).cast("string").alias("texto")).distinct()
    low = F.coalesce(F.translate(F.lower("texto"), ACCENTED, PLAIN), F.lit("none"))
    distinct = distinct.withColumn("low", low).withColumn("generic", F.col("low").rlike(generic_regex))
    asked = distinct.filter("NOT generic").select("low").distinct()

    rows = master.select(fold_lower("Nombre").alias("n"), fold_lower("Apellido").alias("a"),
                         c("Estado").cast("string").alias("e"), c("Oficina").cast("string").alias("o")).filter("n != '' AND a != ''")
    rows = rows.groupBy("n", "a").agg(F.min(F.struct("e", "o")).alias("eo"))
    parts = rows.select(F.col("n").alias("part")).union(rows.select("a")).distinct()
    hits = similar_parts(asked, parts, review)

    names = hits.select("low", F.col("part").alias("n"), F.col("score").alias("sn"))
    surnames = hits.select("low", F.col("part").alias("a"), F.col("score").alias("sa"))
    both = names.join(surnames, "low").join(rows.select("n", "a"), ["n", "a"], "left_semi").select("low", "n", "a", "sn", "sa")
    # a row one of whose names stays below ``review`` has a mean below this
    clear = (100.0 + review) / 2
    done = both.filter(F.col("sn") + F.col("sa") >= 2 * clear).select("low").distinct()
    left = hits.join(done, "low", "left_anti")
    other = 2 * review - F.col("score")  # what the other name needs
    score = partial_score(2 * review - 100.0)
    by_name = left.select("low", F.col("part").alias("n"), "score").join(rows.select("n", "a"), "n").withColumn("sa", score("a", "low"))
    by_surname = left.select("low", F.col("part").alias("a"), "score").join(rows.select("n", "a"), "a").withColumn("sn", score("n", "low"))
    one = by_name.filter(F.col("sa") >= other).select("low", "n", "a", F.col("score").alias("sn"), "sa").unionByName(
        by_surname.filter(F.col("sn") >= other).select("low", "n", "a", "sn", F.col("score").alias("sa")))
    found = both.unionByName(one).withColumn("mean", (F.col("sn") + F.col("sa")) / 2)
    exact = F.contains("low", F.concat_ws(" ", "n", "a"))
    order = F.struct((~exact).alias("fuzzy"), F.when(exact, F.lit(0.0)).otherwise(-F.col("mean")).alias("mean"), "n", "a", "sn", "sa")
    best = found.filter(F.col("mean") >= review).groupBy("low").agg(F.min(order).alias("b")).select("low", "b.*")
    best = best.join(rows, ["n", "a"]).select("low", "fuzzy", (-F.col("mean")).alias("mean"), F.concat_ws(" ", "n", "a").alias("full"), "sn", "sa", "eo")

    res = distinct.join(best, "low", "left")
    hit, is_exact = F.col("full").isNotNull(), ~F.col("fuzzy")
    office = ~F.col("generic") & ~hit & F.col("low").rlike(r"ofi\w*")
    kind = (F.when(F.col("generic") | ~(hit | office), "No detectado").when(office, "Oficina Detectada").when(is_exact, "Exacta")
            .when(F.col("mean") >= accept, "Fuzzy").otherwise("Pendiente de Revisión"))
    perfect = lambda x: F.when(hit & is_exact, F.lit(100.0)).otherwise(F.col(x))
    return res.select(
        "texto", F.when(office, F.col("texto")).otherwise(F.col("full")).alias("nombre_detectado"), F.col("eo.e").alias("Estado"),
        F.when(office, F.trim(F.regexp_extract("low", office_regex, 1))).otherwise(F.col("eo.o")).alias("oficina_comercial"),
        kind.alias("tipo_coincidencia"), perfect("sn").alias("fuzzy_score_nombre"), perfect("sa").alias("fuzzy_score_apellido"),
        perfect("mean").alias("fuzzy_score_combinado"))


def fold_lower(name: str) -> Column:
    """Accent fold + lower + trim (names of the ER-04 master)."""
    return F.trim(F.translate(F.lower(c(name).cast("string")), ACCENTED, PLAIN))


def place_override(df: DataFrame, text_col: str, must_contain: list[str], sets: dict[str, str]) -> DataFrame:
    """ER-05: rows whose text contains every marker get fixed values (e.g. an
    office name and match type)."""
    cond = F.lit(True)
    for m in must_contain:
        cond = cond & F.coalesce(c(text_col).rlike("(?i)" + m), F.lit(False))
    return df.withColumns({k: F.when(cond, F.lit(v)).otherwise(c(k) if k in df.columns else F.lit(None).cast("string"))
                           for k, v in sets.items()})
