"""Vector projections, metrics, filters and searches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import vector as V
from ..operators import filtered as FD
from ..operators import filters as FL
from ..operators import pivots as PV
from ..operators import quantise as QZ
from ..operators import search as S
from ..operators import vectors as VV
from ..operators.grid import grid_top_k
from ..plans import cases as CS
from ..plans import ivf
from ..plans import rotated as RB
from ..session import scratch_path
from ..sources import corpus as SRC
from ..sources import lookup as LK
from .base import C, COS, IP, L2, Q, SC, answer, corpus, profiles, query, r6, scaled, top_sql


def _total(v):
    return F.aggregate(v, F.lit(0.0).cast("double"), lambda a, x: a + x)


def _weighted(v):
    """Position-weighted sum: a one-number fingerprint that notices swapped components."""
    places = F.transform(F.sequence(F.lit(1), F.size(v)), lambda i: i.cast("double"))
    return V.dot(v, places)


W_SQL = "list_inner_product({v}, [i::DOUBLE for i in range(1, len({v}) + 1)])"

# --- projections -----------------------------------------------------------------------------


@query("p1_normalise_corpus", f"""WITH {SC}, u AS (SELECT id, [x / sqrt(list_inner_product(emb, emb)) for x in emb] AS v FROM c)
SELECT id, round(sqrt(list_inner_product(v, v)), 6) AS norm, round({W_SQL.format(v='v')}, 6) AS mark FROM u""")
def normalise_corpus(spark, sf):
    v = scaled(spark, sf).select("id", V.normalise(F.col("emb")).alias("v"))
    return v.select("id", r6(V.norm(F.col("v")), "norm"), r6(_weighted(F.col("v")), "mark"))


@query("p2_normalise_queries", f"""WITH {Q}, u AS (SELECT qid, [x / sqrt(list_inner_product(emb, emb)) for x in emb] AS v FROM q)
SELECT qid, round(sqrt(list_inner_product(v, v)), 6) AS norm, round({W_SQL.format(v='v')}, 6) AS mark FROM u""")
def normalise_queries(spark, sf):
    v = profiles(spark, sf).select("qid", V.normalise(F.col("emb")).alias("v"))
    return v.select("qid", r6(V.norm(F.col("v")), "norm"), r6(_weighted(F.col("v")), "mark"))


@query("p3_cosine_after_normalising", top_sql(COS, ctes=f"{SC}, {Q}"))
def cosine_after_normalising(spark, sf):
    name, first = M.after_normalising("COSINE", target="L2")
    c, q = scaled(spark, sf), profiles(spark, sf)
    if first:
        c, q = c.withColumn("emb", V.normalise(F.col("emb"))), q.withColumn("emb", V.normalise(F.col("emb")))
    found = S.top_k(q, c, 10, name)
    # on unit vectors the squared distance is twice the cosine distance
    return answer(found.withColumn("dist", F.col("dist") * F.col("dist") / 2))


def _pairwise(metric: str):
    """Distance of every row to the mean vector of its own label."""
    def run(spark, sf):
        c = scaled(spark, sf)
        centres = VV.mean_vectors(c, "label").select(F.col("key").alias("label"), F.col("emb").alias("mean"))
        m = M.metric(metric)
        return c.join(centres, "label").select(
            "id", r6(m.distance(F.col("mean"), F.col("emb")), "dist"), r6(m.score(F.col("mean"), F.col("emb")), "score"))

    return run


def _pairwise_sql(distance: str, score: str) -> str:
    return f"""WITH {SC}, parts AS (SELECT label, unnest(emb) AS x, generate_subscripts(emb, 1) AS d FROM c),
means AS (SELECT label, d, avg(x) AS x FROM parts GROUP BY label, d),
q AS (SELECT label, list(x ORDER BY d) AS emb FROM means GROUP BY label)
SELECT c.id, round({distance}, 6) AS dist, round({score}, 6) AS score FROM c JOIN q USING (label)"""


query("p4_l2_distance", _pairwise_sql(L2, L2))(_pairwise("L2"))
query("p5_squared_l2_distance", _pairwise_sql(f"power({L2}, 2)", f"power({L2}, 2)"))(_pairwise("L2_SQUARED"))
query("p6_cosine_distance", _pairwise_sql(COS, "list_cosine_similarity(q.emb, c.emb)"))(_pairwise("COSINE"))
query("p7_inner_product", _pairwise_sql(IP, "list_inner_product(q.emb, c.emb)"))(_pairwise("IP"))

BITS = "[(CASE WHEN x > 0 THEN 1 ELSE 0 END)::BIGINT for x in {v}]"
BC = f"cb AS (SELECT id, {BITS.format(v='emb')} AS emb FROM c)"
BQ = f"qb AS (SELECT qid, {BITS.format(v='emb')} AS emb FROM q)"
HAM = "(list_sum(q.emb) + list_sum(c.emb) - 2 * list_inner_product(q.emb::DOUBLE[], c.emb::DOUBLE[]))::DOUBLE"
BOTH = "list_inner_product(q.emb::DOUBLE[], c.emb::DOUBLE[])"
JAC = f"(1 - {BOTH} / (list_sum(q.emb) + list_sum(c.emb) - {BOTH}))"


def _bit_sql(distance: str) -> str:
    return f"""WITH {C}, {Q}, {BC}, {BQ}, scored AS (SELECT q.qid, c.id, {distance} AS dist FROM qb q, cb c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM scored)
SELECT qid, id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= 10"""


@query("p8_hamming_top_k", _bit_sql(HAM))
def hamming_top_k(spark, sf):
    return answer(S.top_k(QZ.bit_codes(profiles(spark, sf), ["qid"]), QZ.bit_codes(corpus(spark, sf)), 10, "HAMMING"))


@query("p9_jaccard_top_k", _bit_sql(JAC))
def jaccard_top_k(spark, sf):
    return answer(S.top_k(QZ.bit_codes(profiles(spark, sf), ["qid"]), QZ.bit_codes(corpus(spark, sf)), 10, "JACCARD"))


_BIT_PAIR = f"""WITH {C}, {BC}, w AS (SELECT id, emb, lag(emb) OVER (ORDER BY id) AS prev FROM cb)
SELECT id, list_sum([(abs(x))::BIGINT for x in list_transform(list_zip(emb, prev), lambda z: z[1] - z[2])])::BIGINT AS hamming,
round(1 - list_sum(list_transform(list_zip(emb, prev), lambda z: z[1] * z[2]))
  / list_sum(list_transform(list_zip(emb, prev), lambda z: greatest(z[1], z[2]))), 6) AS jaccard
FROM w WHERE prev IS NOT NULL"""


@query("p8_p9_bit_expressions", _BIT_PAIR)
def bit_expressions(spark, sf):
    """Hamming and Jaccard as column expressions between neighbours in id order."""
    words = corpus(spark, sf).select("id", V.pack_words(V.sign_bits(F.col("emb"))).alias("w"))
    left = words.select((F.col("id") + 1).alias("id"), F.col("w").alias("prev"))
    pairs = words.join(left, "id")
    return pairs.select("id", V.hamming_distance(F.col("w"), F.col("prev")).alias("hamming"),
                        r6(V.jaccard_distance(F.col("w"), F.col("prev")), "jaccard"))


@query("p10_metric_by_name", top_sql(IP, ctes=f"{SC}, {Q}"))
def metric_by_name(spark, sf):
    return answer(S.top_k(profiles(spark, sf), scaled(spark, sf), 10, "dp"))


@query("p11_order_by_similarity", f"""WITH {SC}, {Q}, s AS (SELECT q.qid, c.id, list_inner_product(q.emb, c.emb) AS sim FROM q, c),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, id) AS rank FROM s)
SELECT qid, id, round(sim, 6) AS score, rank FROM r WHERE rank <= 10""")
def order_by_similarity(spark, sf):
    m = M.metric("IP")
    q, c = profiles(spark, sf), scaled(spark, sf)
    near = S.top_k(q, c, 10, m.name).withColumn("score", -F.col("dist") if m.higher_is_closer else F.col("dist"))
    place = F.row_number().over(S.Window.partitionBy("qid").orderBy(m.order("score"), "id"))
    return near.select("qid", "id", r6("score", "score"), place.cast("bigint").alias("rank"))


@query("p12_binary_quantise", f"""WITH {C}, {BC} SELECT id, list_aggregate(emb, 'string_agg', '') AS bits FROM cb""")
def binary_quantise(spark, sf):
    return corpus(spark, sf).select("id", F.array_join(V.sign_bits(F.col("emb")).cast("array<string>"), "").alias("bits"))


_PACK = f"""WITH {C}, {BC}, g AS (SELECT id, i, list_sum([(emb[8 * i + j + 1] * (1 << (7 - j)))::BIGINT for j in range(0, 8)]) AS v
FROM cb, (SELECT unnest(range(0, 8)) AS i))
SELECT id, i::BIGINT AS position, (CASE WHEN v > 127 THEN v - 256 ELSE v END)::BIGINT AS code FROM g"""


@query("p13_pack_bits", _PACK)
def pack_bits(spark, sf):
    packed = QZ.bit_codes(corpus(spark, sf))
    return packed.select("id", F.posexplode("emb").alias("position", "code")).select(
        "id", F.col("position").cast("bigint").alias("position"), F.col("code").cast("bigint").alias("code"))


@query("p13_pack_bits_expression", _PACK)
def pack_bits_expression(spark, sf):
    packed = corpus(spark, sf).select("id", V.pack_bytes(V.sign_bits(F.col("emb"))).alias("b"))
    return packed.select("id", F.posexplode("b").alias("position", "code")).select(
        "id", F.col("position").cast("bigint").alias("position"), F.col("code").cast("bigint").alias("code"))


# rounding to 10 mantissa bits, half to even; below 2^-14 the step stays 2^-24
_FP16 = f"""WITH {C}, parts AS (SELECT id, unnest(emb) AS x, generate_subscripts(emb, 1) AS d FROM c),
st AS (SELECT *, power(2.0, greatest(floor(log2(greatest(abs(x), 1e-30))), -14) - 10) AS step FROM parts),
cut AS (SELECT id, x, round_even(x / step, 0) * step AS y FROM st)
SELECT id, round(sum(y), 6) AS total, round(sqrt(sum((x - y) * (x - y))), 6) AS error FROM cut GROUP BY id"""


@query("p14_half_precision", _FP16)
def half_precision(spark, sf):
    h = corpus(spark, sf).select("id", V.half_precision("emb").alias("h"), "emb")
    return h.select("id", r6(_total(V.as_double(F.col("h"))), "total"), r6(V.l2_distance(F.col("h"), F.col("emb")), "error"))


# cutting the lower 16 bits of a float: sign, exponent and 7 mantissa bits remain
_BF16 = f"""WITH {C}, parts AS (SELECT id, unnest(emb) AS x, generate_subscripts(emb, 1) AS d FROM c),
cut AS (SELECT id, d, x, CASE WHEN x = 0 THEN 0 ELSE
  sign(x) * trunc(abs(x) / power(2.0, floor(log2(abs(x))) - 7)) * power(2.0, floor(log2(abs(x))) - 7) END AS y FROM parts)
SELECT id, round(sum(y), 6) AS total, round(sqrt(sum((x - y) * (x - y))), 6) AS error FROM cut GROUP BY id"""


@query("p17_bfloat16", _BF16)
def bfloat16(spark, sf):
    b = corpus(spark, sf).select("id", V.bfloat16("emb").alias("b"), "emb")
    return b.select("id", r6(_total(V.as_double(F.col("b"))), "total"), r6(V.l2_distance(F.col("b"), F.col("emb")), "error"))


_RANGE = f"""{C}, parts AS (SELECT id, unnest(emb) AS x, generate_subscripts(emb, 1) AS d FROM c),
rng AS (SELECT d, min(x) AS lo, max(x) AS hi FROM parts GROUP BY d)"""


@query("p15_scalar_range", f"WITH {_RANGE} SELECT (d - 1)::BIGINT AS dim, round(lo, 6) AS lo, round(hi, 6) AS hi FROM rng")
def scalar_range(spark, sf):
    return QZ.fit_scalar(corpus(spark, sf)).select(F.col("dim").cast("bigint").alias("dim"), r6("lo", "lo"), r6("hi", "hi"))


@query("p15_scalar_quantile_range", f"""WITH {_RANGE}
SELECT (d - 1)::BIGINT AS dim, round(quantile_cont(x, 0.005), 6) AS lo, round(quantile_cont(x, 0.995), 6) AS hi FROM parts GROUP BY d""")
def scalar_quantile_range(spark, sf):
    params = QZ.fit_scalar(corpus(spark, sf), quantile=0.99)
    return params.select(F.col("dim").cast("bigint").alias("dim"), r6("lo", "lo"), r6("hi", "hi"))


def _codes_sql(top: int) -> str:
    return f"""WITH {_RANGE}, coded AS (SELECT id, p.d, greatest(0, least({top}, floor((x - lo) / ((hi - lo) / {top}) + 0.5)))::BIGINT AS code
FROM parts p JOIN rng r ON p.d = r.d)
SELECT id, sum(code)::BIGINT AS total, sum(code * d)::BIGINT AS mark FROM coded GROUP BY id"""


def _codes(bits: int):
    def run(spark, sf):
        c = corpus(spark, sf)
        lo, hi = QZ.range_arrays(QZ.fit_scalar(c))
        codes = QZ.scalar_codes(c, lo, hi, bits)
        return codes.select("id", _total(V.as_double(F.col("emb"))).cast("bigint").alias("total"),
                            _weighted(F.col("emb")).cast("bigint").alias("mark"))

    return run


query("p15_scalar_codes_8_bit", _codes_sql(255))(_codes(8))
query("p15_scalar_codes_6_bit", _codes_sql(63))(_codes(6))


def label_codebooks(spark, sf, m: int = 8):
    """Codebooks by rule: sub-vectors of the ten label means are the ten codes of each sub-space."""
    centres = ivf.Centroids.from_frame(VV.mean_vectors(corpus(spark, sf), "label").select(F.col("key").alias("list_id"), "emb"))
    books = centres.vectors.reshape(len(centres.ids), m, -1)
    return books.transpose(1, 0, 2)


_CENTRES = """cparts AS (SELECT label, unnest(emb) AS x, generate_subscripts(emb, 1) AS d FROM c),
cmeans AS (SELECT label, d, avg(x) AS x FROM cparts GROUP BY label, d),
cent AS (SELECT label AS list_id, list(x ORDER BY d) AS emb FROM cmeans GROUP BY label)"""
_BOOKS = f"""{_CENTRES}, sub AS (SELECT unnest(range(0, 8)) AS s),
book AS (SELECT row_number() OVER (PARTITION BY s ORDER BY list_id) - 1 AS code, s, emb[8 * s + 1 : 8 * s + 8] AS v FROM cent, sub),
csub AS (SELECT id, s, emb[8 * s + 1 : 8 * s + 8] AS v FROM c, sub),
coded AS (SELECT id, s, arg_min(code, (list_distance(csub.v, book.v), code)) AS code FROM csub JOIN book USING (s) GROUP BY id, s)"""


@query("p16_product_codes", f"""WITH {C}, {_BOOKS}
SELECT id, sum(code)::BIGINT AS total, sum(code * (s + 1))::BIGINT AS mark FROM coded GROUP BY id""")
def product_codes(spark, sf):
    codes = QZ.product_codes(corpus(spark, sf), label_codebooks(spark, sf))
    return codes.select("id", _total(V.as_double(F.col("emb"))).cast("bigint").alias("total"),
                        _weighted(F.col("emb")).cast("bigint").alias("mark"))


def _trained_sql(iterations: int) -> str:
    """Codebooks of 4 sub-spaces with 8 codes: rows by rule, then means of the assigned sub-vectors."""
    steps = "".join(f""",
g{i} AS (SELECT x.id, x.s, x.v, arg_min(b.code, (list_distance(x.v, b.v), b.code)) AS code FROM x JOIN k{i} b USING (s) GROUP BY x.id, x.s, x.v),
p{i} AS (SELECT s, code, unnest(v) AS y, generate_subscripts(v, 1) AS d FROM g{i}),
a{i} AS (SELECT s, code, d, avg(y) AS y FROM p{i} GROUP BY s, code, d),
k{i + 1} AS (SELECT s, code, list(y ORDER BY d) AS v FROM a{i} GROUP BY s, code
UNION ALL SELECT s, code, v FROM k{i} WHERE (s, code) NOT IN (SELECT (s, code) FROM a{i}))""" for i in range(iterations))
    return f"""WITH {C}, part AS (SELECT unnest(range(0, 4)) AS s), x AS (SELECT id, s, emb[16 * s + 1 : 16 * s + 16] AS v FROM c, part),
seeds AS (SELECT id, row_number() OVER (ORDER BY sha256('7:' || CAST(id AS VARCHAR)), id) - 1 AS code FROM c),
k0 AS (SELECT s, code, v FROM seeds JOIN x USING (id) WHERE code < 8){steps}"""


@query("p16_product_codebook_training", f"""{_trained_sql(3)}, coded AS (SELECT x.id, x.s, arg_min(b.code, (list_distance(x.v, b.v), b.code)) AS code FROM x JOIN k3 b USING (s) GROUP BY x.id, x.s)
SELECT id, sum(code)::BIGINT AS total FROM coded GROUP BY id""")
def product_training(spark, sf):
    """Codes under codebooks trained in three iterations from rows chosen by rule."""
    c = corpus(spark, sf)
    books = QZ.fit_codebooks(c, 4, 3, iterations=3)
    codes = QZ.product_codes(c, books)
    return codes.select("id", _total(V.as_double(F.col("emb"))).cast("bigint").alias("total"))


@query("p16_trained_codebooks", f"""{_trained_sql(3)} SELECT s::BIGINT AS s, code::BIGINT AS code, d::BIGINT AS d, round(y, 6) AS value
FROM (SELECT s, code, unnest(v) AS y, generate_subscripts(v, 1) - 1 AS d FROM k3)""")
def trained_codebooks(spark, sf):
    books = QZ.fit_codebooks(corpus(spark, sf), 4, 3, iterations=3)
    rows = [(s, code, d, float(books[s, code, d])) for s, code, d in np.ndindex(books.shape)]
    return spark.createDataFrame(rows, "s bigint, code bigint, d bigint, value double").withColumn("value", r6("value"))


@query("p18_replicate_corpus", """WITH n AS (SELECT count(*) AS n FROM embeddings)
SELECT vec_id + k * n AS id, label::BIGINT AS label FROM embeddings, n, (SELECT unnest(range(0, 3)) AS k)""")
def replicate(spark, sf):
    c = corpus(spark, sf)
    return SRC.replicated(c.select("id", "label"), 3, c.count())


@query("p19_ids_only", f"SELECT qid, id, rank FROM ({top_sql(L2)})")
def ids_only(spark, sf):
    return answer(S.top_k(profiles(spark, sf), corpus(spark, sf), 10)).select("qid", "id", "rank")


# --- searches and filters --------------------------------------------------------------------


@query("j1_top_k_l2", top_sql(L2))
def top_k_l2(spark, sf):
    return answer(S.top_k(profiles(spark, sf), corpus(spark, sf), 10, "L2"))


@query("j1_top_k_cosine", top_sql(COS, ctes=f"{SC}, {Q}"))
def top_k_cosine(spark, sf):
    return answer(S.top_k(profiles(spark, sf), scaled(spark, sf), 10, "COSINE"))


@query("j1_top_k_inner_product", top_sql(IP, ctes=f"{SC}, {Q}"))
def top_k_ip(spark, sf):
    return answer(S.top_k(profiles(spark, sf), scaled(spark, sf), 10, "IP"))


@query("j1_top_k_squared_l2", top_sql(f"power({L2}, 2)", ctes=f"{SC}, {Q}"))
def top_k_squared(spark, sf):
    return answer(S.top_k(profiles(spark, sf), scaled(spark, sf), 10, "L2_SQUARED"))


_SELF = "q AS (SELECT id AS qid, emb FROM c)"


@query("j1_top_k_every_row_as_query", top_sql(L2, ctes=f"{SC}, {_SELF}"))
def top_k_self(spark, sf):
    """Every corpus row asks; queries and rows meet in a grid of blocks and never pass the driver."""
    c = scaled(spark, sf)
    return answer(grid_top_k(c.select(F.col("id").alias("qid"), "emb"), c, 10, "L2"))


@query("j2_ground_truth_of_every_row", f"""SELECT qid AS id, rank AS position, id AS neighbor FROM ({top_sql(COS, ctes=f"{SC}, {_SELF}")})""")
def whole_truth(spark, sf):
    """Exact neighbours of every corpus row, as lists."""
    c = scaled(spark, sf)
    truth = S.answer_lists(grid_top_k(c.select(F.col("id").alias("qid"), "emb"), c, 10, "COSINE"), ids="neighbors_id")
    return truth.select(F.col("qid").alias("id"), F.posexplode("neighbors_id").alias("p", "neighbor")).select(
        "id", (F.col("p") + 1).cast("bigint").alias("position"), "neighbor")


@query("t1_top_100_default", top_sql(L2, k=100))
def top_100(spark, sf):
    return answer(S.top_k(profiles(spark, sf), corpus(spark, sf)))


@query("t2_top_k_single_query", f"""WITH {C}, parts AS (SELECT unnest(emb) AS x, generate_subscripts(emb, 1) AS d FROM c),
m AS (SELECT d, avg(x) AS x FROM parts GROUP BY d), q AS (SELECT list(x ORDER BY d) AS emb FROM m)
SELECT c.id, round({L2}, 6) AS dist FROM c, q ORDER BY {L2}, id LIMIT 10""")
def top_k_single(spark, sf):
    c = corpus(spark, sf)
    mean = VV.mean_vectors(c.withColumn("one", F.lit(1)), "one").first()["emb"]
    return S.top_k_one(mean, c, 10).select("id", r6("dist", "dist"))


def _id_rate(rate: float, strict: bool = False):
    def run(spark, sf):
        c = corpus(spark, sf)
        keep = FL.IdFilter(c.count(), rate, strict=strict)
        return answer(S.top_k(profiles(spark, sf), c, 10, "L2", keep.predicate()))

    return run


def _id_rate_sql(rate: float, op: str = ">=") -> str:
    return top_sql(L2, where=f"c.id {op} (SELECT trunc(count(*) * {rate}::DOUBLE)::BIGINT FROM embeddings)")


@query("f1_no_filter", top_sql(L2))
def no_filter(spark, sf):
    return answer(S.top_k(profiles(spark, sf), corpus(spark, sf), 10, "L2", FL.NoFilter().predicate()))


for _rate, _name in ((0.01, "1p"), (0.1, "10p"), (0.5, "50p"), (0.9, "90p"), (0.99, "99p")):
    query(f"f2_id_filter_{_name}", _id_rate_sql(_rate))(_id_rate(_rate))
query("f3_strict_id_filter_50p", _id_rate_sql(0.5, ">"))(_id_rate(0.5, strict=True))

# share labels: hundredths of the id space, as in a corpus that carries one label per share
SHARE_SQL = """CASE WHEN {id} % 100 < 1 THEN 'label_1p' WHEN {id} % 100 < 3 THEN 'label_2p' WHEN {id} % 100 < 8 THEN 'label_5p'
WHEN {id} % 100 < 18 THEN 'label_10p' WHEN {id} % 100 < 38 THEN 'label_20p' WHEN {id} % 100 < 88 THEN 'label_50p' ELSE 'label_12p' END"""


def share_labels(spark, sf):
    """Separate label table (id, labels) over the whole corpus."""
    return corpus(spark, sf).select("id", F.expr(SHARE_SQL.format(id="id")).alias("labels"))


def _labelled(share: float):
    def run(spark, sf):
        keep = FL.LabelFilter(share)
        rows = SRC.attach_labels(corpus(spark, sf), share_labels(spark, sf))
        return answer(S.top_k(profiles(spark, sf), rows, 10, "L2", keep.predicate()))

    return run


for _share, _label in ((0.01, "label_1p"), (0.05, "label_5p"), (0.5, "label_50p")):
    query(f"f4_{_label}_filter", top_sql(L2, where=f"{SHARE_SQL.format(id='c.id')} = '{_label}'"))(_labelled(_share))


@query("f5_exact_id", f"""WITH {C}, m AS (SELECT max(id) AS top FROM c)
SELECT id, label, round(list_sum(emb), 6) AS total FROM c, m WHERE id = top""")
def exact_id(spark, sf):
    c = corpus(spark, sf)
    last = c.agg(F.max("id")).first()[0]
    return c.filter(FL.id_is(last)).select("id", "label", r6(_total(V.as_double(F.col("emb"))), "total"))


@query("f6_range_and_exact", top_sql(L2, where="c.id >= (SELECT count(*) // 2 FROM embeddings) AND c.label = 3"))
def range_and_exact(spark, sf):
    c = corpus(spark, sf)
    keep = FL.all_of(FL.IdFilter(c.count(), 0.5).predicate(), FL.id_is(3, "label"))
    return answer(S.top_k(profiles(spark, sf), c, 10, "L2", keep))


@query("f7_prefilter", top_sql(L2, k=100, where="c.label = 5"))
def prefilter(spark, sf):
    return answer(S.top_k(profiles(spark, sf), corpus(spark, sf), 100, "L2", F.col("label") == 5))


@query("f8_dimension_check", """SELECT count(*) FILTER (len(embedding) = 64) AS accepted, count(*) FILTER (len(embedding) <> 64) AS rejected FROM embeddings""")
def dimension_check(spark, sf):
    ok, bad = FL.split_by_dimension(corpus(spark, sf), 64)
    both = ok.select(F.lit(1).alias("a"), F.lit(0).alias("r")).unionByName(bad.select(F.lit(0).alias("a"), F.lit(1).alias("r")))
    return both.agg(F.sum("a").cast("bigint").alias("accepted"), F.sum("r").cast("bigint").alias("rejected"))


@query("f9_column_counts", """SELECT count(vec_id) AS id, count(embedding) AS emb, count(label) AS label,
count(vec_id) = count(embedding) AND count(vec_id) = count(label) AS equal FROM embeddings""")
def column_counts(spark, sf):
    return FL.column_counts(corpus(spark, sf), "id", "emb", "label")


@query("j2_ground_truth", f"""SELECT qid AS id, rank AS position, id AS neighbor FROM ({top_sql(L2)})""")
def ground_truth(spark, sf):
    truth = S.ground_truth(profiles(spark, sf), corpus(spark, sf), 10)
    return truth.select("id", F.posexplode("neighbors_id").alias("p", "neighbor")).select(
        "id", (F.col("p") + 1).cast("bigint").alias("position"), "neighbor")


@query("j2_filtered_ground_truth", f"""SELECT qid AS id, rank AS position, id AS neighbor FROM ({_id_rate_sql(0.9)})""")
def filtered_truth(spark, sf):
    c = corpus(spark, sf)
    truth = S.ground_truth(profiles(spark, sf), c, 10, "L2", FL.IdFilter(c.count(), 0.9).predicate())
    return truth.select("id", F.posexplode("neighbors_id").alias("p", "neighbor")).select(
        "id", (F.col("p") + 1).cast("bigint").alias("position"), "neighbor")


_CASES = f"""f AS (SELECT concat('id ', rate) AS filter, trunc((SELECT count(*) FROM embeddings) * rate)::BIGINT AS least, NULL AS label
FROM (SELECT unnest({CS.ID_RATES})::DOUBLE AS rate) UNION ALL SELECT concat('label ', v), NULL, v FROM (SELECT unnest(['label_1p', 'label_2p', 'label_5p', 'label_10p',
'label_12p', 'label_20p', 'label_50p', 'label_99p']) AS v))"""


@query("j2_ground_truth_of_all_filters", f"""WITH {C}, {Q}, {_CASES}, s AS (SELECT q.qid, c.id, {L2} AS dist, {SHARE_SQL.format(id='c.id')} AS labels FROM q, c),
ranked AS (SELECT filter, qid, id, row_number() OVER (PARTITION BY filter, qid ORDER BY dist, id) AS rank FROM s JOIN f ON s.id >= f.least OR s.labels = f.label)
SELECT split_part(filter, ' ', 1) AS kind, round_even(CASE WHEN filter LIKE 'id %' THEN split_part(filter, ' ', 2)::DOUBLE END, 6) AS rate,
CASE WHEN filter LIKE 'label %' THEN split_part(filter, ' ', 2) END AS label, qid AS id, rank AS position, id AS neighbor FROM ranked WHERE rank <= 10""")
def truth_of_all_filters(spark, sf):
    """Neighbours under every id rate and every label, in one scan."""
    c = corpus(spark, sf)
    size = c.count()
    rates = {f"id {r}": FL.IdFilter(size, r).value for r in CS.ID_RATES}
    shares = {f"label {v}": v for v in ("label_1p", "label_2p", "label_5p", "label_10p", "label_12p", "label_20p", "label_50p", "label_99p")}
    labelled = SRC.attach_labels(c.select("id", "emb"), share_labels(spark, sf))
    truth = FD.ground_truths(profiles(spark, sf), labelled, 10, "L2", rates, shares)
    parts = F.split("filter", " ")
    return truth.select(parts[0].alias("kind"), F.when(parts[0] == "id", parts[1].try_cast("double")).alias("rate"), F.when(parts[0] == "label", parts[1]).alias("label"), "id",
                        F.posexplode("neighbors_id").alias("p", "neighbor")).withColumn("position", (F.col("p") + 1).cast("bigint")).drop("p")


@query("j3_attach_labels", f"""SELECT {SHARE_SQL.format(id='vec_id')} AS labels, count(*) AS n, sum(label)::BIGINT AS total FROM embeddings GROUP BY 1""")
def attach_labels(spark, sf):
    rows = SRC.attach_labels(corpus(spark, sf), share_labels(spark, sf))
    return rows.groupBy("labels").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("total"))


_RERANKED = f"""WITH {C}, {Q}, {BC}, {BQ},
s AS (SELECT q.qid, c.id, {HAM} AS d FROM qb q, cb c),
w AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS r FROM s),
e AS (SELECT w.qid, w.id, {L2} AS dist FROM w JOIN q USING (qid) JOIN c USING (id) WHERE r <= 50),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM e)
SELECT qid, id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= 10"""


@query("j5_rerank_candidates", _RERANKED)
def rerank_candidates(spark, sf):
    q, c = profiles(spark, sf), corpus(spark, sf)
    wide = S.top_k(QZ.bit_codes(q, ["qid"]), QZ.bit_codes(c), 50, "HAMMING")
    return answer(S.rerank(q, c, wide, 10, "L2", q.count() * 50))


@query("j5_rerank_by_lookup", _RERANKED)
def rerank_by_lookup(spark, sf):
    """The same candidates looked up in a table sorted by id."""
    q, c = profiles(spark, sf), corpus(spark, sf).select("id", "emb")
    stored = LK.write_lookup(c, scratch_path(spark, "lookup"), files=4)
    wide = S.top_k(QZ.bit_codes(q, ["qid"]), QZ.bit_codes(c), 50, "HAMMING")
    return answer(LK.rerank_by_lookup(q, stored, wide, 10, "L2"))


_RADIUS = f"""WITH {C}, {Q}, s AS (SELECT q.qid, c.id, {L2} AS dist FROM q, c),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM s WHERE dist <= 0.95)
SELECT qid, id, round(dist, 6) AS dist, rank, count(*) OVER (PARTITION BY qid) >= 5 AS enough FROM r WHERE rank <= 20"""


@query("j7_radius_search", _RADIUS)
def radius_search(spark, sf):
    found = S.radius_search(profiles(spark, sf), corpus(spark, sf), 0.95, 20, 5)
    return found.select("qid", "id", r6("dist", "dist"), F.col("rank").cast("bigint").alias("rank"), "enough")


@query("j7_radius_search_by_pivots", _RADIUS)
def radius_search_by_pivots(spark, sf):
    c = corpus(spark, sf)
    pivots = PV.choose_pivots(c)
    stored = PV.write_pivots(c, pivots, scratch_path(spark, "pivots"))
    found = PV.radius_search_by_pivots(profiles(spark, sf), stored, pivots, 0.95, 20, 5)
    return found.select("qid", "id", r6("dist", "dist"), F.col("rank").cast("bigint").alias("rank"), "enough")


def _bit_rerank_sql(width: str, final: str, k: int = 10) -> str:
    return f"""WITH {C}, {Q}, {BC}, {BQ},
s AS (SELECT q.qid, c.id, {HAM} AS d FROM qb q, cb c),
w AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS r FROM s),
e AS (SELECT w.qid, w.id, {final} AS dist FROM w JOIN q USING (qid) JOIN c USING (id) WHERE r <= {width}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM e)
SELECT qid, id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= {k}"""


@query("t3_two_phase_other_metric", _bit_rerank_sql("100", COS))
def two_phase_other_metric(spark, sf):
    return answer(ivf.bit_top_k(profiles(spark, sf), corpus(spark, sf), 10, 10.0, "COSINE"))


@query("t4_oversampling", _bit_rerank_sql("25", L2))
def oversampling(spark, sf):
    return answer(ivf.bit_top_k(profiles(spark, sf), corpus(spark, sf), 10, 2.59, "L2"))


@query("t5_capped_candidates", _bit_rerank_sql("least(10000, 10 * 3)", L2))
def capped(spark, sf):
    q, c = profiles(spark, sf), corpus(spark, sf)
    width = S.candidate_width(10, 3, cap=10_000)
    return answer(S.rerank(q, c, S.top_k(QZ.bit_codes(q, ["qid"]), QZ.bit_codes(c), width, "HAMMING"), 10, "L2", q.count() * width))


@query("t5_exact_mode", top_sql(COS))
def exact_mode(spark, sf):
    return answer(S.top_k(profiles(spark, sf), corpus(spark, sf), 10, "COSINE"))


@query("w2_rank_within_query", f"SELECT qid, id, rank FROM ({top_sql(IP, ctes=f'{SC}, {Q}')})")
def rank_within_query(spark, sf):
    near = S.top_k(profiles(spark, sf), scaled(spark, sf), 10, "IP").drop("rank")
    return near.select("qid", "id", S.rank_within(["qid"]).cast("bigint").alias("rank"))


# --- inverted-file and coded tables ------------------------------------------------------------

_ASSIGN = f"""{_CENTRES}, assigned AS (SELECT c.id, arg_min(cent.list_id, (list_distance(c.emb, cent.emb), cent.list_id)) AS list_id
FROM c, cent GROUP BY c.id)"""
_PROBE = """pr AS (SELECT q.qid, cent.list_id, list_distance(q.emb, cent.emb) AS d,
row_number() OVER (PARTITION BY q.qid ORDER BY list_distance(q.emb, cent.emb), cent.list_id) AS r FROM q, cent)"""


def centroids(spark, sf) -> ivf.Centroids:
    """Centroids by rule: the mean vector of each label."""
    return ivf.Centroids.from_frame(VV.mean_vectors(corpus(spark, sf), "label").select(F.col("key").alias("list_id"), "emb"))


def lists(spark, sf, cents):
    return ivf.write_lists(ivf.assign(corpus(spark, sf).select("id", "emb"), cents), scratch_path(spark, "lists"))


@query("n2_ivf_assign", f"WITH {C}, {_ASSIGN} SELECT id, list_id FROM assigned")
def ivf_assign(spark, sf):
    return ivf.assign(corpus(spark, sf).select("id", "emb"), centroids(spark, sf)).select("id", "list_id")


@query("j6_probe_lists", f"WITH {C}, {Q}, {_CENTRES}, {_PROBE} SELECT qid, list_id, round(d, 6) AS dist, r AS rank FROM pr WHERE r <= 3")
def probe_lists(spark, sf):
    found = ivf.probe_lists(profiles(spark, sf), centroids(spark, sf), 3)
    return found.select("qid", "list_id", r6("dist", "dist"), F.col("rank").cast("bigint").alias("rank"))


def _ivf_sql(nprobe: int, distance: str = L2) -> str:
    return f"""WITH {C}, {Q}, {_ASSIGN}, {_PROBE},
s AS (SELECT q.qid, c.id, {distance} AS dist FROM pr JOIN q USING (qid) JOIN assigned a USING (list_id) JOIN c ON c.id = a.id WHERE pr.r <= {nprobe}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM s)
SELECT qid, id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= 10"""


def _ivf(nprobe: int, metric: str = "L2"):
    def run(spark, sf):
        cents = centroids(spark, sf)
        return answer(ivf.ivf_top_k(profiles(spark, sf), lists(spark, sf, cents), cents, 10, nprobe, metric))

    return run


query("n2_ivf_flat_1_probe", _ivf_sql(1))(_ivf(1))
query("n2_ivf_flat_3_probes", _ivf_sql(3))(_ivf(3))
query("n2_ivf_flat_all_probes", top_sql(L2))(_ivf(10))
query("n2_ivf_flat_cosine", _ivf_sql(3, COS))(_ivf(3, "COSINE"))


@query("n1_flat", top_sql(L2))
def flat(spark, sf):
    from ..plans.performance import Flat

    search = Flat()
    return answer(search.search(profiles(spark, sf), search.build(corpus(spark, sf)), 10, "L2"))


_DECODED = """crange AS (SELECT d, min(x) AS lo, max(x) AS hi FROM cparts GROUP BY d),
cx AS (SELECT id, unnest(emb) AS x, generate_subscripts(emb, 1) AS d FROM c),
cdec AS (SELECT cx.id, list(greatest(0, least({top}, floor((x - lo) / ((hi - lo) / {top}) + 0.5))) * ((hi - lo) / {top}) + lo ORDER BY cx.d) AS emb
FROM cx JOIN crange ON cx.d = crange.d GROUP BY cx.id)"""


@query("n3_ivf_sq8", f"""WITH {C}, {Q}, {_ASSIGN}, {_PROBE}, {_DECODED.format(top=255)},
s AS (SELECT q.qid, c.id, {L2} AS dist FROM pr JOIN q USING (qid) JOIN assigned a USING (list_id) JOIN cdec c ON c.id = a.id WHERE pr.r <= 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM s)
SELECT qid, id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= 10""")
def ivf_sq8(spark, sf):
    cents = centroids(spark, sf)
    stored = ivf.store_scalar_lists(corpus(spark, sf), cents, scratch_path(spark, "scalar-lists"))
    return answer(ivf.ivf_scalar_top_k(profiles(spark, sf), stored, cents, 10, 3))


@query("n4_ivf_pq", f"""WITH {C}, {Q}, {_BOOKS}, assigned AS (SELECT c.id, arg_min(cent.list_id, (list_distance(c.emb, cent.emb), cent.list_id)) AS list_id
FROM c, cent GROUP BY c.id), {_PROBE},
qsub AS (SELECT qid, s, emb[8 * s + 1 : 8 * s + 8] AS v FROM q, sub),
lut AS (SELECT qid, s, code, power(list_distance(qsub.v, book.v), 2) AS d FROM qsub JOIN book USING (s)),
dd AS (SELECT lut.qid, coded.id, sqrt(sum(lut.d)) AS dist FROM coded JOIN lut ON coded.s = lut.s AND coded.code = lut.code
JOIN assigned a ON a.id = coded.id JOIN pr ON pr.qid = lut.qid AND pr.list_id = a.list_id AND pr.r <= 3 GROUP BY lut.qid, coded.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), id) AS rank FROM dd)
SELECT qid, id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= 10""")
def ivf_pq(spark, sf):
    cents = centroids(spark, sf)
    books = label_codebooks(spark, sf)
    stored = ivf.store_product_lists(corpus(spark, sf), cents, books, scratch_path(spark, "product-lists"))
    return answer(ivf.ivf_product_top_k(profiles(spark, sf), stored, cents, 10, 3, books))


_RES = f"""WITH {C}, {Q}, {_ASSIGN}, {_PROBE},
rc AS (SELECT c.id, a.list_id, [(CASE WHEN z[1] > z[2] THEN 1 ELSE 0 END)::BIGINT for z in list_zip(c.emb, cent.emb)] AS emb
FROM c JOIN assigned a ON a.id = c.id JOIN cent ON cent.list_id = a.list_id),
rq AS (SELECT q.qid, cent.list_id, [(CASE WHEN z[1] > z[2] THEN 1 ELSE 0 END)::BIGINT for z in list_zip(q.emb, cent.emb)] AS emb
FROM pr JOIN q USING (qid) JOIN cent USING (list_id) WHERE pr.r <= 3),
s AS (SELECT q.qid, c.id, {HAM} AS d FROM rq q JOIN rc c USING (list_id)),
w AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS r FROM s),
e AS (SELECT w.qid, w.id, {L2} AS dist FROM w JOIN q USING (qid) JOIN c USING (id) WHERE r <= 40),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM e)
SELECT qid, id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= 10"""


@query("n5_ivf_bits_refined", _RES)
def ivf_bits(spark, sf):
    cents = centroids(spark, sf)
    coded = ivf.write_lists(ivf.residual_codes(corpus(spark, sf), cents), scratch_path(spark, "bit-lists"))
    return answer(ivf.ivf_bit_top_k(profiles(spark, sf), coded, cents, 10, 3, 4))


_ROTATED = f"""WITH {C}, {Q}, {_ASSIGN}, {_PROBE},
turn AS (SELECT i, list(CASE WHEN (bit_count(i & j) + (j * (j + 1)) // 2) % 2 = 0 THEN 0.125::DOUBLE ELSE -0.125::DOUBLE END ORDER BY j) AS line
FROM (SELECT unnest(range(0, 64)) AS i) a, (SELECT unnest(range(0, 64)) AS j) b GROUP BY i),
res AS (SELECT c.id, a.list_id, [z[1] - z[2] for z in list_zip(c.emb, cent.emb)] AS v FROM c JOIN assigned a ON a.id = c.id JOIN cent ON cent.list_id = a.list_id),
rc AS (SELECT id, list_id, list(list_inner_product(v, line) ORDER BY i) AS y FROM res, turn GROUP BY id, list_id),
codes AS (SELECT id, list_id, [CASE WHEN x > 0 THEN 1::DOUBLE ELSE -1::DOUBLE END for x in y] AS bits, sqrt(list_inner_product(y, y)) AS size,
list_sum([abs(x) for x in y]) / (8 * sqrt(list_inner_product(y, y))) AS fit FROM rc),
qres AS (SELECT q.qid, cent.list_id, [z[1] - z[2] for z in list_zip(q.emb, cent.emb)] AS v FROM pr JOIN q USING (qid) JOIN cent USING (list_id) WHERE pr.r <= 3),
rq AS (SELECT qid, list_id, list(list_inner_product(v, line) ORDER BY i) AS y FROM qres, turn GROUP BY qid, list_id),
b AS (SELECT rq.qid, k.id, k.size * k.size + list_inner_product(rq.y, rq.y) - 2 * k.size * list_inner_product(rq.y, k.bits) / (8 * k.fit) AS est,
2 * 1.9 * k.size * sqrt(list_inner_product(rq.y, rq.y)) * sqrt(greatest(0, 1 - k.fit * k.fit) / (k.fit * k.fit)) / sqrt(63) AS err FROM rq JOIN codes k USING (list_id)),
kth AS (SELECT n.qid, max(power({L2}, 2)) AS bound FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY est, id) AS r FROM b) n
JOIN q USING (qid) JOIN c USING (id) WHERE r <= 10 GROUP BY n.qid),
e AS (SELECT b.qid, b.id, {L2} AS dist FROM b JOIN kth USING (qid) JOIN q USING (qid) JOIN c USING (id) WHERE est - err <= bound),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM e)
SELECT qid, id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= 10"""


@query("n5_ivf_rotated_bits", _ROTATED)
def ivf_rotated_bits(spark, sf):
    """1-bit codes under a rotation by rule; only rows whose bound beats the k-th best are compared exactly."""
    search = RB.RotatedBits(nprobe=3, centroids=centroids(spark, sf), rotation=RB.hadamard_rotation(64))
    return answer(search.search(profiles(spark, sf), search.build(corpus(spark, sf)), 10, "L2"))


@query("n6_bits_and_rerank", _bit_rerank_sql("100", L2))
def bits_and_rerank(spark, sf):
    from ..plans.performance import BitCodes

    search = BitCodes(10.0)
    return answer(search.search(profiles(spark, sf), search.build(corpus(spark, sf)), 10, "L2"))


@query("n7_scalar_codes_rescored", f"""WITH {C}, {Q}, cparts AS (SELECT unnest(emb) AS x, generate_subscripts(emb, 1) AS d FROM c), {_DECODED.format(top=63)},
s AS (SELECT q.qid, c.id, {L2} AS d FROM q, cdec c),
w AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS r FROM s),
e AS (SELECT w.qid, w.id, {L2} AS dist FROM w JOIN q USING (qid) JOIN c USING (id) WHERE r <= 15),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM e)
SELECT qid, id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= 10""")
def scalar_rescored(spark, sf):
    from ..plans.performance import ScalarCodes

    search = ScalarCodes(1.5, 6)
    return answer(search.search(profiles(spark, sf), search.build(corpus(spark, sf)), 10, "L2"))


@query("n8_partition_by_label", top_sql(L2, where=f"{SHARE_SQL.format(id='c.id')} = 'label_5p'"))
def partition_by_label(spark, sf):
    rows = SRC.attach_labels(corpus(spark, sf).select("id", "emb"), share_labels(spark, sf))
    stored = SRC.write_by_label(rows, scratch_path(spark, "by-label"))
    return answer(S.top_k(profiles(spark, sf), stored, 10, "L2", FL.LabelFilter(0.05).predicate()))


@query("n9_sorted_by_id", _id_rate_sql(0.9))
def sorted_by_id(spark, sf):
    c = corpus(spark, sf)
    stored = SRC.write_sorted(c, scratch_path(spark, "sorted"))
    return answer(S.top_k(profiles(spark, sf), stored, 10, "L2", FL.IdFilter(c.count(), 0.9).predicate()))
