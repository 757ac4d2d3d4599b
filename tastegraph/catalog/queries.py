"""Registered queries: ``(spark, sf_dir) -> DataFrame``, each over whole tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tastegraph.catalog import inputs
from tastegraph.functions.columns import tidy
from tastegraph.functions.hashing import SMALL_PRIME
from tastegraph.operators import evaluate, factors, iterative, knn, labels, lsh, onehash, pearson, permuted, setjoin, tiles
from tastegraph.operators import ratings as prep
from tastegraph.plans.durable import durable, scratch_path
from tastegraph.plans.numbering import dense_numbers
from tastegraph.sources import readers, writers

NEIGHBORS = 10
USER_LSH = {"bands": 33, "rows": 2}
SET_COSINE = 0.2
WORD_COSINE = 0.7
ONE_HASH_BINS = 64
TILE = 32
# the smallest whole factor with which cells are imputed and the signed sums stay well away from zero
IMPUTE_FACTOR = (2, 1)


def _tidy(df, *columns):
    return df.select(*[tidy(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def _split(spark, sf_dir):
    return inputs.ratings(spark, sf_dir), inputs.test_ratings(spark, sf_dir)


def _train(spark, sf_dir):
    return prep.holdout(*_split(spark, sf_dir))


def _written(frame, spark, sf_dir):
    """For operators that read their input more than once."""
    return durable(frame(spark, sf_dir))


# rating preparation


def ratings_dedup(spark, sf_dir):
    return inputs.ratings(spark, sf_dir)


def holdout_train(spark, sf_dir):
    return _train(spark, sf_dir)


def holdout_triple(spark, sf_dir):
    return prep.holdout(*_split(spark, sf_dir), on="triple")


def train_test_union(spark, sf_dir):
    _, test = _split(spark, sf_dir)
    return prep.with_test(_train(spark, sf_dir), test)


def user_means(spark, sf_dir):
    return _tidy(prep.means(_train(spark, sf_dir)), "mean")


def mean_centered(spark, sf_dir):
    return _tidy(prep.mean_center(_written(_train, spark, sf_dir)), "mean", "centered")


def presence_flags(spark, sf_dir):
    """Which of all rated pairs the test set holds."""
    return prep.presence(*_split(spark, sf_dir))


def user_degrees(spark, sf_dir):
    return prep.degrees(_train(spark, sf_dir), "user")


def item_degrees(spark, sf_dir):
    return prep.degrees(_train(spark, sf_dir), "item")


def density_gamma(spark, sf_dir):
    return prep.density_gamma(_written(_train, spark, sf_dir))


def user_rating_lists(spark, sf_dir):
    lists = prep.rating_lists(_written(inputs.ratings, spark, sf_dir), part_rows=16)
    whole = F.transform("ratings", lambda r: r.cast("long"))
    return lists.select(
        "id",
        "part",
        F.array_join(F.col("elements").cast("array<string>"), " ").alias("elements"),
        F.array_join(whole.cast("array<string>"), " ").alias("ratings"),
    )


def item_rating_maps(spark, sf_dir):
    maps = prep.rating_maps(inputs.ratings(spark, sf_dir), by="item", part_rows=16)
    total = F.aggregate(F.map_values("ratings"), F.lit(0.0), lambda s, r: s + r)
    keys = F.array_join(F.array_sort(F.map_keys("ratings")).cast("array<string>"), " ")
    return maps.select("id", "part", keys.alias("users"), total.cast("long").alias("total"))


# Pearson and neighbourhoods


def pearson_users(spark, sf_dir):
    return _tidy(pearson.pearson_pairs(_written(inputs.ratings, spark, sf_dir), "user"), "similarity")


def pearson_items(spark, sf_dir):
    return _tidy(pearson.pearson_pairs(_written(inputs.ratings, spark, sf_dir), "item"), "similarity")


def pearson_users_support3(spark, sf_dir):
    return _tidy(pearson.pearson_pairs(_written(inputs.ratings, spark, sf_dir), "user", min_support=3), "similarity")


def pearson_users_all(spark, sf_dir):
    """With pairs of similarity 0, also those of one common item."""
    return _tidy(pearson.pearson_pairs(_written(inputs.ratings, spark, sf_dir), "user", keep_zero=True), "similarity")


def topk_neighbors(spark, sf_dir):
    return _tidy(knn.neighbor_lists(_written(_train, spark, sf_dir), "user", NEIGHBORS), "weight")


def _predicted(df):
    return _tidy(df, "prediction")


def user_knn(spark, sf_dir):
    return _predicted(knn.predict_user_knn(*_split(spark, sf_dir)))


def user_knn_topk(spark, sf_dir):
    return _predicted(knn.predict_user_knn(*_split(spark, sf_dir), k=3, cut=0.05, exclude_target_from_mean=True))


def user_knn_global(spark, sf_dir):
    """The strongest neighbours of the user, of which only some rated the target."""
    return _predicted(knn.predict_user_knn(*_split(spark, sf_dir), k=NEIGHBORS, neighborhood="global"))


def item_knn_global(spark, sf_dir):
    found = knn.predict_item_knn(*_split(spark, sf_dir), k=NEIGHBORS, neighborhood="global", rescale=None)
    return _predicted(found)


def user_knn_leaky(spark, sf_dir):
    return _predicted(knn.predict_user_knn(*_split(spark, sf_dir), leaky=True))


def item_knn(spark, sf_dir):
    return _predicted(knn.predict_item_knn(*_split(spark, sf_dir)))


def item_knn_leaky(spark, sf_dir):
    return _predicted(knn.predict_item_knn(*_split(spark, sf_dir), leaky=True))


def item_knn_clamped(spark, sf_dir):
    return _predicted(knn.predict_item_knn(*_split(spark, sf_dir), k=5, rescale="clamp", low=1.0))


def user_knn_candidates(spark, sf_dir):
    everything, test = _split(spark, sf_dir)
    pairs = lsh.minhash_candidates(_train(spark, sf_dir), "user", "item", **USER_LSH)
    return _predicted(knn.predict_user_knn(everything, test, candidates=pairs))


def item_knn_candidates(spark, sf_dir):
    everything, test = _split(spark, sf_dir)
    pairs = lsh.minhash_candidates(_train(spark, sf_dir), "item", "user", **USER_LSH)
    return _predicted(knn.predict_item_knn(everything, test, candidates=pairs))


# evaluation


def _scored(spark, sf_dir):
    everything, test = _split(spark, sf_dir)
    return evaluate.score(knn.predict_user_knn(everything, test), test)


def user_knn_scored(spark, sf_dir):
    return _tidy(_scored(spark, sf_dir), "prediction", "abs_error")


def user_knn_error_hist(spark, sf_dir):
    return evaluate.error_histogram(_scored(spark, sf_dir))


def user_knn_rmse(spark, sf_dir):
    return _tidy(evaluate.rmse(_scored(spark, sf_dir)), "rmse")


def item_knn_quality(spark, sf_dir):
    everything, test = _split(spark, sf_dir)
    return _tidy(evaluate.rating_quality(knn.predict_item_knn(everything, test), test), "value")


# MinHash


def _rating_bands(spark, sf_dir):
    everything = _written(inputs.ratings, spark, sf_dir)
    users = prep.distinct_count(everything, "user")
    return lsh.minhash_bands(prep.interactions(everything), prime=SMALL_PRIME, universe=users, code=None)


def minhash_signature_rows(spark, sf_dir):
    return lsh.signature_rows(_rating_bands(spark, sf_dir))


def minhash_signatures(spark, sf_dir):
    listed = lsh.signatures(_rating_bands(spark, sf_dir))
    return listed.select("id", F.array_join(F.col("signature").cast("array<string>"), " ").alias("signature"))


def minhash_rows_without_modulus(spark, sf_dir):
    everything = _written(inputs.ratings, spark, sf_dir)
    users = prep.distinct_count(everything, "user")
    return lsh.signature_rows(lsh.minhash_bands(prep.interactions(everything), prime=None, universe=users, code=None))


def lsh_candidates(spark, sf_dir):
    return lsh.minhash_candidates(inputs.words(spark, sf_dir), "doc_id", "word")


def lsh_candidates_small_prime(spark, sf_dir):
    return lsh.minhash_candidates(inputs.words(spark, sf_dir), "doc_id", "word", prime=SMALL_PRIME)


def _jaccard_lsh(spark, sf_dir):
    return lsh.jaccard_lsh_join(inputs.words(spark, sf_dir), "doc_id", "word")


def jaccard_lsh_join(spark, sf_dir):
    return _tidy(_jaccard_lsh(spark, sf_dir), "similarity")


def jaccard_exact(spark, sf_dir):
    return _tidy(setjoin.jaccard_join(inputs.words(spark, sf_dir), "doc_id", "word"), "similarity")


def lsh_pair_quality(spark, sf_dir):
    exact = setjoin.jaccard_join(inputs.words(spark, sf_dir), "doc_id", "word")
    return _tidy(evaluate.pair_quality(_jaccard_lsh(spark, sf_dir), exact), "precision", "recall")


def one_hash_signatures(spark, sf_dir):
    """One-permutation signatures of the items' users."""
    sets = prep.interactions(inputs.ratings(spark, sf_dir))
    listed = onehash.one_hash_signatures(sets, ONE_HASH_BINS)
    return listed.select("id", F.array_join(F.col("signature").cast("array<string>"), " ").alias("signature"))


def jaccard_one_hash_join(spark, sf_dir):
    return _tidy(onehash.jaccard_one_hash_join(inputs.words(spark, sf_dir), "doc_id", "word"), "similarity")


def item_vector_tiles(spark, sf_dir):
    """The dense item × user matrix in tiles."""
    found = tiles.dense_tiles(inputs.ratings(spark, sf_dir), tile_rows=TILE, tile_columns=TILE)
    whole = F.col("values").cast("array<bigint>").cast("array<string>")
    return found.select("row_tile", "column_tile", F.array_join(whole, " ").alias("cells"))


# cosine


def cosine_sets(spark, sf_dir):
    sets = inputs.ratings(spark, sf_dir)
    return _tidy(setjoin.cosine_join(sets, "item", "user", SET_COSINE), "similarity")


def cosine_words(spark, sf_dir):
    return _tidy(setjoin.cosine_join(inputs.words(spark, sf_dir), "doc_id", "word", WORD_COSINE), "similarity")


def cosine_lsh_sets(spark, sf_dir):
    found = lsh.cosine_lsh_join(inputs.words(spark, sf_dir), "doc_id", "word", WORD_COSINE)
    return _tidy(found, "similarity")


def _recall_check(quality, promised):
    recall = F.coalesce("recall", F.lit(1.0))
    # three standard errors of a share among so many pairs
    slack = F.lit(3 * math.sqrt(promised * (1 - promised))) / F.sqrt(F.greatest(F.col("tp") + F.col("fn"), F.lit(1)))
    return quality.select(
        (F.col("tp") + F.col("fn")).alias("pairs"), (recall >= F.lit(promised) - slack).alias("recall_met"),
        F.coalesce("precision", F.lit(1.0)).alias("precision"),
    )


def cosine_set_quality(spark, sf_dir):
    """Sign bands against the exact join: whether the recall is at least the promised one."""
    exact = durable(setjoin.cosine_join(inputs.words(spark, sf_dir), "doc_id", "word", WORD_COSINE))
    found = lsh.cosine_lsh_join(inputs.words(spark, sf_dir), "doc_id", "word", WORD_COSINE)
    return _recall_check(evaluate.pair_quality(found, exact), lsh.RECALL)


def cosine_permuted_sets(spark, sf_dir):
    found = permuted.cosine_permuted_join(inputs.words(spark, sf_dir), "doc_id", "word", WORD_COSINE)
    return _tidy(found, "similarity")


def cosine_permuted_quality(spark, sf_dir):
    """The sorted permutations against the exact join."""
    exact = durable(setjoin.cosine_join(inputs.words(spark, sf_dir), "doc_id", "word", WORD_COSINE))
    found = durable(permuted.cosine_permuted_join(inputs.words(spark, sf_dir), "doc_id", "word", WORD_COSINE))
    quality = evaluate.pair_quality(found, exact)
    return _tidy(quality.select("tp", "fn", "precision", "recall"), "precision", "recall")


def row_numbers(spark, sf_dir):
    """All ratings in the order of user and item, numbered from 0, and each user's from 0 as well."""
    rated = inputs.ratings(spark, sf_dir)
    numbered = dense_numbers(rated, ["user", "item"])
    return dense_numbers(numbered, ["item"], ["user"], "place", "items")


def pairs_relabelled(spark, sf_dir):
    """The exact join of word sets with text ids, on dense numbers inside and with the ids at both ends of a pair."""
    words = inputs.words(spark, sf_dir).withColumn("doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))
    numbers = labels.label_numbers(words, "doc_id")
    found = setjoin.cosine_join(labels.encoded(words, "doc_id", numbers), "doc_id", "word", WORD_COSINE)
    return _tidy(labels.relabelled(found, numbers), "similarity")


def cosine_vectors(spark, sf_dir):
    vectors = inputs.embeddings(spark, sf_dir)
    found = lsh.cosine_join_vectors(vectors, "vec_id", "embedding", inputs.EMBEDDING_DIMS)
    return _tidy(found, "similarity")


def cosine_vector_quality(spark, sf_dir):
    """Sign bands against all pairs: whether the recall is what the bands promise at the threshold."""
    vectors = inputs.embeddings(spark, sf_dir)
    exact = durable(lsh.cosine_join_vectors(vectors, "vec_id", "embedding", inputs.EMBEDDING_DIMS))
    found = lsh.cosine_join_vectors(vectors, "vec_id", "embedding", inputs.EMBEDDING_DIMS, bits=300, rows=5)
    quality = evaluate.pair_quality(found, exact)
    promised = 1 - (1 - (1 - math.acos(0.47) / math.pi) ** 5) ** 60
    return _recall_check(quality, promised)


# iterative and model-based prediction


def iterative_cf(spark, sf_dir):
    found = iterative.predict_iterative(*_split(spark, sf_dir))
    return _predicted(found.select("user", "item", "prediction"))


def iterative_cf_imputed(spark, sf_dir):
    found = iterative.predict_iterative(
        *_split(spark, sf_dir), gamma_factor=IMPUTE_FACTOR, rescale="clamp"
    )
    # imputed values divide by signed sums and lose digits, so compare three
    return found.select("user", "item", tidy(F.col("prediction"), 3).alias("prediction"))


def als_predictions(spark, sf_dir):
    return _predicted(factors.predict_als(*_split(spark, sf_dir), rescale=None))


def als_rescaled(spark, sf_dir):
    return _predicted(factors.predict_als(*_split(spark, sf_dir)))


def als_scored_pairs(spark, sf_dir):
    """The test pairs that get a prediction."""
    return factors.predict_als(*_split(spark, sf_dir), rescale=None).select("user", "item")


def als_range(spark, sf_dir):
    """The ends of the rescaled predictions."""
    found = factors.predict_als(*_split(spark, sf_dir))
    return found.agg(F.round(F.min("prediction"), 6).alias("low"), F.round(F.max("prediction"), 6).alias("high"))


def als_dropped(spark, sf_dir):
    everything, test = _split(spark, sf_dir)
    return factors.dropped_pairs(factors.predict_als(everything, test, rescale=None), test)


# sources and sinks


def ratings_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "ratings")
    inputs.ratings(spark, sf_dir).select("user", "item", "rating", F.lit("x").alias("extra")).write.csv(
        path, header=True
    )
    return readers.read_ratings(spark, path)


def text_interactions_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "interactions")
    inputs.ratings(spark, sf_dir).select("user", "item", "rating").write.csv(path, header=True)
    return readers.read_interactions(spark, path, text_ids=True)


def interactions_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "interactions")
    inputs.ratings(spark, sf_dir).select("user", "item", "rating").write.csv(path, header=True)
    return readers.read_interactions(spark, path)


def predictions_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    writers.write_predictions(user_knn(spark, sf_dir), path)
    return spark.read.schema("user long, item long, prediction double").csv(path)


def pairs_csv_similarity(spark, sf_dir):
    path = scratch_path(spark, "pairs")
    writers.write_pairs(setjoin.jaccard_join(inputs.words(spark, sf_dir), "doc_id", "word"), path)
    return _tidy(spark.read.schema("a long, b long, similarity double").csv(path), "similarity")


def pairs_sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "pairs")
    pairs = setjoin.jaccard_join(inputs.words(spark, sf_dir), "doc_id", "word")
    writers.write_pairs(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"), path)
    return readers.read_pairs(spark, path)


def predictions_sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    writers.write_predictions(user_knn(spark, sf_dir), path, "parquet")
    return spark.read.parquet(path)


def written_quality(spark, sf_dir):
    """The report on predictions, observed while they are written."""
    everything, test = _split(spark, sf_dir)
    report = writers.write_evaluated(knn.predict_user_knn(everything, test), test, scratch_path(spark, "evaluated"))
    return _tidy(report, "value")


def predictions_sink_order(spark, sf_dir):
    """Each written prediction with its line in the part files, taken in the order of their names."""
    path = scratch_path(spark, "predictions")
    writers.write_predictions(user_knn(spark, sf_dir), path)
    lines = spark.read.schema("user long, item long, prediction double").csv(path)
    placed = lines.select("*", "_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    order = ["file_name", "file_block_start", "at"]
    return dense_numbers(placed, order, name="line").drop(*order)


# plain filter and group queries


def _events(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events")


def count_not_matching(spark, sf_dir):
    return _events(spark, sf_dir).where(F.col("event_type") != "view").agg(F.count(F.lit(1)).alias("n"))


def count_per_group(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def mean_per_group(spark, sf_dir):
    picked = _events(spark, sf_dir).where(F.col("event_type") == "purchase")
    return _tidy(picked.groupBy("user_id").agg(F.avg("value").alias("mean_value")), "mean_value")


QUERIES = {
    f.__name__: f
    for f in (
        ratings_dedup, holdout_train, holdout_triple, train_test_union, user_means, mean_centered, presence_flags,
        user_degrees, item_degrees, density_gamma, user_rating_lists, item_rating_maps,
        pearson_users, pearson_items, pearson_users_support3, pearson_users_all, topk_neighbors,
        user_knn, user_knn_topk, user_knn_leaky, user_knn_global, item_knn_global, item_knn, item_knn_leaky, item_knn_clamped,
        user_knn_candidates, item_knn_candidates,
        user_knn_scored, user_knn_error_hist, user_knn_rmse, item_knn_quality,
        minhash_signature_rows, minhash_signatures, minhash_rows_without_modulus, lsh_candidates, lsh_candidates_small_prime,
        jaccard_lsh_join, jaccard_exact, lsh_pair_quality, one_hash_signatures, jaccard_one_hash_join, item_vector_tiles,
        cosine_sets, cosine_words, cosine_lsh_sets, cosine_set_quality, cosine_permuted_sets,
        cosine_permuted_quality, row_numbers, pairs_relabelled, cosine_vectors, cosine_vector_quality,
        iterative_cf, iterative_cf_imputed, als_predictions, als_rescaled, als_dropped, als_scored_pairs, als_range,
        ratings_csv_roundtrip, text_interactions_roundtrip, interactions_roundtrip, predictions_csv_roundtrip,
        pairs_csv_similarity, pairs_sink_roundtrip, predictions_sink_roundtrip,
        written_quality, predictions_sink_order,
        count_not_matching, count_per_group, mean_per_group,
    )
}
