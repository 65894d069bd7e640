"""Model queries: quality of labelled documents from numbers read off their text."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tabloom.catalogue.common import rounded, spread_table, table
from tabloom.functions import text
from tabloom.operators import attribution, boosting, evaluate, features, guided, logits, models, stacks, tuning
from tabloom.session import cut_lineage

KEY = "doc_id"
NUMBERS = ["n_chars", "words", "digit_share", "capital_share", "line_breaks", "word_length"]
FOLDS = 5
TRIALS = 10
PATIENCE = 100
# node: (feature, threshold); the children of node n are 2n + 1 and 2n + 2
PART_SPLITS = {0: (0, 25.0), 1: (3, 16.0), 2: (1, 1200.0), 3: (2, 14.0), 4: (0, 10.0), 5: (3, 20.0), 6: (0, 40.0), 9: (1, 1000.0)}
# the tuned leaf-wise settings of the bank model; fewer rounds and an earlier stop than its 200 and 100, see README
LEAFWISE = boosting.Boosting(
    rounds=40, learning_rate=0.1, num_leaves=28, max_depth=4, lambda_l1=0.135, feature_fraction=0.95, bagging_fraction=0.82, bagging_freq=7, patience=10
)
STRENGTHS = [0.001, 0.01, 0.1, 1, 10, 100, 1000]


def document_facts(spark, folder):
    """doc_id, label and predictors of the labelled documents."""
    docs = spread_table(spark, folder, "documents", KEY)
    labels = table(spark, folder, "labels").select(KEY, F.col("quality").cast("double").alias("label"))
    body = F.col("text")
    size = F.greatest(F.length(body), F.lit(1))

    def share(pattern: str):
        return F.length(F.regexp_replace(body, pattern, "")) / size

    words = F.greatest(F.size(text.split_spaces(body)), F.lit(1))
    facts = docs.select(
        KEY,
        "lang",
        F.col("n_chars").cast("double").alias("n_chars"),
        words.cast("double").alias("words"),
        (1 - share("[0-9]")).alias("digit_share"),
        (1 - share(r"\p{Lu}")).alias("capital_share"),
        (F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit("")))).cast("double").alias("line_breaks"),
        (size / words).alias("word_length"),
    )
    return facts.join(labels, KEY)


def _training(spark, folder):
    """Stored training frame with features, label, weight and fold, and the slot names."""
    facts = cut_lineage(document_facts(spark, folder))
    weighted = features.with_class_weights(facts, "label")
    folded = features.fold_assignment(weighted, KEY, "label", FOLDS)
    pipeline = features.feature_pipeline(NUMBERS, ["lang"])
    ready = pipeline.fit(folded).transform(folded)
    names = models.feature_names(ready, NUMBERS)
    return cut_lineage(ready.select(KEY, "label", "weight", "fold", *NUMBERS, "features")), names


def assembled(spark, folder):
    """The feature vectors, one row per slot."""
    from pyspark.ml.functions import vector_to_array

    rows, _ = _training(spark, folder)
    slots = rows.select(KEY, F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return slots.select(KEY, "slot", rounded(F.col("value"), "value"))


def _fit_scores(spark, folder, build):
    rows, _ = _training(spark, folder)
    return models.scored_predictions(build(rows).fit(rows), rows, KEY)


def _logit_rows(spark, folder):
    """The stored training rows with their features as an array, and the number of slots."""
    from pyspark.ml.functions import vector_to_array

    rows, names = _training(spark, folder)
    return cut_lineage(rows.select(KEY, "label", "weight", "fold", vector_to_array("features").alias("x"))), len(names)


def fit_logistic(spark, folder):
    """Scores of the L1 model with C = 1 and balanced weights."""
    rows, size = _logit_rows(spark, folder)
    fitted = logits.fit_logits(rows, [logits.Logit("l1", tuple(range(size)), 1.0, True)])
    scored = logits.logit_scores(fitted, rows, [KEY, "label"])
    pred = (F.col("score") > 0.5).cast("int").alias("pred")
    return scored.select(KEY, F.col("label").cast("int").alias("truth"), pred, rounded(F.col("score"), "score", 5))


def logistic_coefficients(spark, folder):
    """Coefficients of both penalties and of models that leave a fold out, all of one batch."""
    rows, size = _logit_rows(spark, folder)
    slots = tuple(range(size))
    specs = [logits.Logit(f"{'l1' if l1 else 'l2'}, {held}", slots, 1.0, l1, held) for l1 in (True, False) for held in (None, 0, 1)]
    found = logits.coefficients(logits.fit_logits(rows, specs, fold="fold"), rows)
    return found.select("model", "slot", (F.round("value", 5) + F.lit(0.0)).alias("value"))  # no negative zero


def fit_tree(spark, folder):
    return _fit_scores(spark, folder, lambda rows: models.decision_tree("entropy", max_depth=5))


def fit_forest(spark, folder):
    return _fit_scores(spark, folder, lambda rows: models.random_forest(20, 5, 7))


def fit_gbt(spark, folder):
    return _fit_scores(spark, folder, lambda rows: models.boosted_trees(10, 0.1, 3, 0.82, 0.95))


def fit_gbt_early_stop(spark, folder):
    rows, _ = _training(spark, folder)
    split = cut_lineage(features.stratified_split(rows, KEY, "label"))
    train, valid = split.filter("part = 'train'"), split.filter("part = 'test'")
    model = models.fit_until_best(models.boosted_trees(20, 0.1, 3), train, valid, PATIENCE)
    return models.scored_predictions(model, split, KEY).withColumn("trees", F.lit(model.getNumTrees))


def fit_leafwise(spark, folder):
    """Leaf-wise boosting that stops on the test documents; scores by the best number of trees."""
    weighted = features.with_class_weights(cut_lineage(document_facts(spark, folder)), "label")
    split = cut_lineage(features.stratified_split(weighted, KEY, "label"))
    model = boosting.fit_leafwise(split, NUMBERS, [KEY], LEAFWISE, valid=F.col("part") == "test")
    scored = split.select(KEY, "part", F.col("label").cast("int").alias("truth")).join(model.scores(split, [KEY]), KEY)
    return scored.select(KEY, "part", "truth", (F.col("score") > 0.5).cast("int").alias("pred"), "score", F.lit(model.best).alias("trees"))


def univariate_logistic(spark, folder):
    found = logits.univariate(cut_lineage(document_facts(spark, folder)), NUMBERS)
    return found.select("feature", rounded(F.col("slope"), "slope", 8), rounded(F.col("intercept"), "intercept", 5))


def score_table(spark, folder):
    """Scores of the held-out documents by the L2 model of the others."""
    rows, size = _logit_rows(spark, folder)
    split = features.hash_split(rows, KEY).withColumn("fold", F.when(F.col("part") == "test", 1).otherwise(0))
    fitted = logits.fit_logits(split, [logits.Logit("l2", tuple(range(size)), 1.0, held=1)], fold="fold")
    return logits.logit_scores(fitted, split, [KEY, "fold"], fold="fold").select(KEY, rounded(F.col("score"), "score", 5))


def cv_scores(spark, folder):
    rows, size = _logit_rows(spark, folder)
    report = logits.cross_validated(rows, size, FOLDS, {"l2": (1.0, False)})[1]
    return report.filter("fold IS NOT NULL").select("fold", rounded(F.col("auc"), "auc"))


def logistic_grid(spark, folder):
    """Train and cross-validated AUC of every strength and penalty; all folds of all points are one batch."""
    rows, size = _logit_rows(spark, folder)
    points = {f"C={c:g}, {kind}": (c, kind == "l1") for c in STRENGTHS for kind in ("l1", "l2")}
    report = logits.grid_report(logits.cross_validated(rows, size, FOLDS, points)[1])
    return report.select("point", *[rounded(F.col(c), c, 5) for c in ("train_auc", "cv_auc", "cv_std")], "best")


def grid_search(spark, folder):
    rows, _ = _training(spark, folder)
    tree = models.decision_tree()
    grid = (
        ParamGridBuilder()
        .addGrid(tree.maxDepth, [2, 3, 4, 5, 6, 8])
        .addGrid(tree.impurity, ["gini", "entropy"])
        .addGrid(tree.minInstancesPerNode, [1, 5])
        .build()
    )
    return tuning.grid_search(tree, grid, rows, FOLDS)[1]


def random_search(spark, folder):
    rows, _ = _training(spark, folder)
    split = cut_lineage(features.stratified_split(rows, KEY, "label"))
    space = {
        "learning_rate": ("log", 1e-2, 3e-1),
        "max_depth": ("int", 2, 4),
        "bagging_fraction": ("uniform", 0.4, 1.0),
        "feature_fraction": ("uniform", 0.4, 1.0),
    }
    return tuning.random_search(
        lambda **p: models.boosted_trees(5, **p), space, split.filter("part = 'train'"), split.filter("part = 'test'"), TRIALS
    )


def guided_search(spark, folder):
    """Size, depth and features per split of a forest by the guided search, 20 trials, four at a time."""
    rows, _ = _training(spark, folder)
    split = cut_lineage(features.stratified_split(rows, KEY, "label"))
    space = {"trees": ("int", 2, 30), "max_depth": ("int", 2, 8), "max_features": ("int", 1, 12)}
    return guided.guided_search(models.random_forest, space, split.filter("part = 'train'"), split.filter("part = 'test'"), 20)


def select_by_importance(spark, folder):
    rows, names = _training(spark, folder)
    return tuning.select_by_importance(rows, names, FOLDS)[1]


def recursive_elimination(spark, folder):
    rows, names = _training(spark, folder)
    return tuning.recursive_elimination(rows, names, FOLDS)


def _stack(rows):
    bases = {
        "forest": models.random_forest(10, 5),
        "logistic": models.logistic(models.weight_sum(rows), penalty="l1"),
    }
    return tuning.fit_stack(bases, rows, KEY, FOLDS)


def stacking(spark, folder):
    rows, _ = _training(spark, folder)
    return models.scored_predictions(_stack(rows), rows, KEY)


def stack_grid(spark, folder):
    """Train and cross-validated AUC of stacks over base and top parameters; each base is fitted once per fold."""
    rows, _ = _training(spark, folder)
    bases = {
        "forest": {f"depth {d}": models.random_forest(10, d) for d in (5, 10)},
        "logistic": {f"C={c}": models.logistic(models.weight_sum(rows), c, "l1") for c in (1, 5)},
    }
    report = stacks.tune_stack(bases, rows, KEY, FOLDS, (0.1, 1.0, 10.0))[1]
    return report.select("point", *[rounded(F.col(c), c, 5) for c in ("train_auc", "cv_auc", "cv_std")], "best")


def fitted_comparison(spark, folder):
    """Accuracy, precision, recall, F1 and AUC of five models on held-out documents."""
    rows, _ = _training(spark, folder)
    split = cut_lineage(features.hash_split(rows, KEY))
    train, test = split.filter("part = 'train'"), split.filter("part = 'test'")
    fitted = {
        "logistic": models.logistic(models.weight_sum(train), 0.1).fit(train),
        "tree": models.decision_tree().fit(train),
        "forest": models.random_forest(20, 5).fit(train),
        "boosting": models.boosted_trees(10).fit(train),
        "stacking": _stack(train),
    }
    parts = [models.scored_predictions(m, test, KEY, n) for n, m in fitted.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return evaluate.model_comparison(cut_lineage(whole))


def importance_rank(spark, folder):
    rows, names = _training(spark, folder)
    return models.importance_rank(models.random_forest(20, 5).fit(rows), names, rows)


def fitted_attribution(spark, folder):
    """Mean absolute contribution of each number to a fitted linear score."""
    facts = features.min_max_scale(cut_lineage(document_facts(spark, folder)), NUMBERS)[0]
    ready = VectorAssembler(inputCols=NUMBERS, outputCol="features").transform(
        features.with_class_weights(facts, "label")
    )
    model = models.logistic(models.weight_sum(ready)).fit(ready)
    weights = dict(zip(NUMBERS, [float(w) for w in model.coefficients]))
    return evaluate.attribution_bars(evaluate.linear_attribution(facts, weights), NUMBERS)


def permutation_importance(spark, folder):
    facts = features.with_class_weights(cut_lineage(document_facts(spark, folder)), "label")
    assembler = VectorAssembler(inputCols=NUMBERS, outputCol="features")
    model = models.random_forest(20, 5).fit(assembler.transform(facts))
    return tuning.permutation_importance(model, facts, KEY, NUMBERS, assembler)


def tree_attribution(spark, folder):
    """Shapley values of a tree with fixed splits on parts; its leaves hold the shares of steel parts."""
    parts = table(spark, folder, "part")
    columns = [F.col("p_size").cast("double"), F.col("p_retailprice"), F.length("p_name").cast("double"), F.length("p_type").cast("double")]
    nodes = attribution.nodes_of_splits(parts, PART_SPLITS, columns, F.col("p_type").contains("STEEL"))
    rows = parts.select("p_partkey", F.array(*columns).alias("x"))
    found = attribution.tree_attribution(rows, attribution.tree_paths(nodes), ["p_partkey"], len(columns))
    return found.select("p_partkey", "feature", (F.round("value", 9) + F.lit(0.0)).alias("value"))  # no negative zero


def forest_attribution(spark, folder):
    """Mean absolute Shapley value of each feature of a forest over the labelled documents."""
    from pyspark.ml.functions import vector_to_array

    rows, names = _training(spark, folder)
    model = models.random_forest(20, 5).fit(rows)
    paths = cut_lineage(attribution.tree_paths(cut_lineage(attribution.tree_nodes(model))))
    arrays = rows.select(KEY, vector_to_array("features").alias("x"))
    bars = attribution.mean_attribution(attribution.tree_attribution(arrays, paths, [KEY], len(names)))
    named = F.array(*[F.lit(n) for n in names])
    return bars.select(named[F.col("feature")].alias("feature"), rounded(F.col("importance"), "importance", 9))


def word_vectors(spark, folder):
    """Vectors of the words of the conversations, one row per number."""
    chat = spread_table(spark, folder, "conversations", "conv_id")
    sentences = chat.select(text.split_spaces(text.normalise(F.col("text"))).alias("tokens"))
    found = features.word_vectors(sentences, "tokens", size=16, window=3)
    return found.select("word", F.posexplode("vec").alias("dim", "value"))


QUERIES = {
    "assembled_features": assembled,
    "fit_logistic": fit_logistic,
    "logistic_coefficients": logistic_coefficients,
    "fit_tree": fit_tree,
    "fit_forest": fit_forest,
    "fit_gbt": fit_gbt,
    "fit_gbt_early_stop": fit_gbt_early_stop,
    "fit_leafwise": fit_leafwise,
    "univariate_logistic": univariate_logistic,
    "score_table": score_table,
    "cv_scores": cv_scores,
    "logistic_grid": logistic_grid,
    "grid_search": grid_search,
    "random_search": random_search,
    "guided_search": guided_search,
    "select_by_importance": select_by_importance,
    "recursive_elimination": recursive_elimination,
    "stacking": stacking,
    "stack_grid": stack_grid,
    "fitted_comparison": fitted_comparison,
    "importance_rank": importance_rank,
    "fitted_attribution": fitted_attribution,
    "permutation_importance": permutation_importance,
    "tree_attribution": tree_attribution,
    "forest_attribution": forest_attribution,
    "word_vectors": word_vectors,
}

_FACTS = """
    facts AS (
      SELECT doc_id, lang, CAST(n_chars AS DOUBLE) AS n_chars, CAST(len(str_split(text, ' ')) AS DOUBLE) AS words,
             1 - length(regexp_replace(text, '[0-9]', '', 'g')) / length(text) AS digit_share,
             1 - length(regexp_replace(text, '\\p{Lu}', '', 'g')) / length(text) AS capital_share,
             CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS line_breaks,
             length(text) / len(str_split(text, ' ')) AS word_length
      FROM documents JOIN labels USING (doc_id)),
    levels AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS ix FROM (SELECT DISTINCT lang FROM facts))"""

_SCALED = ", ".join(f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())" for c in NUMBERS)
_IN_FOLDS = "(row_number() OVER (PARTITION BY l.quality ORDER BY md5('42' || chr(31) || f.doc_id), f.doc_id) - 1) % 5"
_IN_PARTS = "CASE WHEN CAST('0x' || substr(md5('42' || chr(31) || f.doc_id), 1, 8) AS BIGINT) / 4294967296.0 < 0.7 THEN 0 ELSE 1 END"


def _fits(models: str, fold: str = _IN_FOLDS, steps: int = 25, sweeps: int = 60) -> str:
    """CTEs up to `fit` (model, held, l1, l2, step, beta): Newton steps, each solved by sweeps over the coordinates.

    `models` selects (model, held, l1, l2); the last slot of a row is the
    intercept.
    """
    slots = "unnest(range(1, (SELECT max(len(x)) FROM rows_) + 1))"
    bound = "CASE WHEN i = len(b) THEN 0 ELSE {} END"
    pull = "(h[i][i] * v - g[i] - list_dot_product(h[i], b))"
    return f"""{_FACTS},
    labelled AS (
      SELECT f.*, l.quality, {fold} AS fold, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY l.quality)) AS w
      FROM facts f JOIN labels l USING (doc_id)),
    rows_ AS (
      SELECT doc_id, quality AS y, fold, CAST(w AS DOUBLE) AS w, list_concat([{_SCALED}], list_concat(
        (SELECT list(CASE WHEN v.lang = labelled.lang THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END ORDER BY v.ix) FROM levels v),
        [CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)])) AS x
      FROM labelled),
    models AS ({models}),
    sweeps AS (SELECT list(CAST(i AS DOUBLE) ORDER BY s, i) AS visits FROM range({sweeps}) a(s), (SELECT {slots} AS i)),
    fit AS (
      SELECT model, held, l1, l2, 0 AS step, (SELECT list_transform(any_value(x), lambda v: CAST(0 AS DOUBLE)) FROM rows_) AS beta FROM models
      UNION ALL
      SELECT model, held, l1, l2, step + 1, list_reduce(list_concat([beta], list_transform(visits, lambda v: [v])),
        lambda b, e: list_transform(b, lambda v, i: CASE WHEN i <> e[1] THEN v WHEN h[i][i] + l2 < 1e-12 THEN 0.0
          ELSE greatest(abs{pull} - {bound.format("l1")}, 0) * sign{pull} / (h[i][i] + {bound.format("l2")}) END))
      FROM (
        SELECT model, held, l1, l2, step, beta, list(gi - hb ORDER BY i) AS g, list(hi ORDER BY i) AS h FROM (
          SELECT model, held, l1, l2, step, beta, i, any_value(gi) AS gi, list(hij ORDER BY j) AS hi,
                 list_dot_product(list(hij ORDER BY j), beta) AS hb
          FROM (
            SELECT model, held, l1, l2, step, beta, i, j, sum(w * (p - y) * x[i]) AS gi, sum(w * p * (1 - p) * x[i] * x[j]) AS hij
            FROM (
              SELECT f.*, r.x, r.y, r.w, 1 / (1 + exp(-list_dot_product(f.beta, r.x))) AS p
              FROM fit f JOIN rows_ r ON f.held IS NULL OR r.fold <> f.held WHERE f.step < {steps}) seen,
              (SELECT {slots} AS i) a, (SELECT {slots} AS j) b
            GROUP BY model, held, l1, l2, step, beta, i, j) cells
          GROUP BY model, held, l1, l2, step, beta, i) lines
        GROUP BY model, held, l1, l2, step, beta) sums, sweeps),
    scored AS (
      SELECT model, held, doc_id, fold, y, 1 / (1 + exp(-list_dot_product(beta, x))) AS score FROM fit, rows_ WHERE step = {steps}),
    aucs AS (
      SELECT a.model, a.held, a.fold = a.held AS unseen, avg(CASE WHEN p > q THEN 1 WHEN p = q THEN 0.5 ELSE 0 END) AS auc
      FROM (SELECT model, held, fold = held AS seen, fold, y, round(score, 9) AS p FROM scored WHERE y = 1) a
      JOIN (SELECT model, held, fold = held AS seen, y, round(score, 9) AS q FROM scored WHERE y = 0) b
        ON a.model = b.model AND a.held IS NOT DISTINCT FROM b.held AND a.seen IS NOT DISTINCT FROM b.seen
      GROUP BY ALL)"""


_L1 = "SELECT 'l1' AS model, CAST(NULL AS INTEGER) AS held, CAST(1 AS DOUBLE) AS l1, CAST(0 AS DOUBLE) AS l2"
_L2 = "SELECT 'l2' AS model, CAST({held} AS INTEGER) AS held, CAST(0 AS DOUBLE) AS l1, CAST(1 AS DOUBLE) AS l2"
_BOTH = """SELECT kind || ', ' || coalesce(CAST(held AS VARCHAR), 'None') AS model, held, CAST(kind = 'l1' AS DOUBLE) AS l1, CAST(kind = 'l2' AS DOUBLE) AS l2
    FROM (SELECT unnest(['l1', 'l2']) AS kind), (SELECT unnest([NULL, 0, 1]) AS held)"""

def _ways_sql() -> str:
    """Rows (leaf, node, feature, threshold, goes left) along the way to each leaf."""
    ways = []
    for leaf in sorted({c for n in PART_SPLITS for c in (2 * n + 1, 2 * n + 2)} - PART_SPLITS.keys()):
        n = leaf
        while n:
            parent = (n - 1) // 2
            ways.append(f"({leaf}, {parent}, {PART_SPLITS[parent][0]}, {PART_SPLITS[parent][1]}, {'true' if n % 2 else 'false'})")
            n = parent
    return ", ".join(ways)


# every subset of the four features by itself: the value of a subset is the expectation with its features known
_TREE_ATTRIBUTION = f"""
    WITH ways(leaf, node, feature, threshold, goes_left) AS (VALUES {_ways_sql()}),
    x AS (SELECT p_partkey, [CAST(p_size AS DOUBLE), p_retailprice, CAST(length(p_name) AS DOUBLE), CAST(length(p_type) AS DOUBLE)] AS x,
                 CASE WHEN p_type LIKE '%STEEL%' THEN 1.0 ELSE 0.0 END AS y FROM part),
    tests AS (SELECT p_partkey, y, leaf, feature, node, (x[feature + 1] <= threshold) = goes_left AS ok FROM x, ways),
    leaves AS (SELECT p_partkey, any_value(y) AS y, leaf FROM tests GROUP BY p_partkey, leaf HAVING bool_and(ok)),
    sizes AS (SELECT leaf, count(*) AS n, avg(y) AS value FROM leaves GROUP BY leaf),
    covers AS (SELECT w.node, sum(n) AS n, sum(n) FILTER (WHERE goes_left) AS n_left FROM ways w JOIN sizes USING (leaf) GROUP BY w.node),
    shares AS (SELECT leaf, feature, product(CASE WHEN goes_left THEN n_left ELSE n - n_left END / CAST(n AS DOUBLE)) AS z
               FROM ways JOIN covers USING (node) WHERE leaf IN (SELECT leaf FROM sizes) GROUP BY leaf, feature),
    o AS (SELECT p_partkey, leaf, feature, CASE WHEN bool_and(ok) THEN 1.0 ELSE 0.0 END AS o FROM tests GROUP BY p_partkey, leaf, feature),
    subsets AS (SELECT unnest(range(16)) AS s),
    reached AS (SELECT p_partkey, leaf, s, product(CASE WHEN s & (1 << feature) <> 0 THEN o ELSE z END) AS share
                FROM o JOIN shares USING (leaf, feature), subsets GROUP BY p_partkey, leaf, s),
    f AS (SELECT p_partkey, s, sum(share * value) AS f FROM reached JOIN sizes USING (leaf) GROUP BY p_partkey, s)
    SELECT a.p_partkey, i AS feature, round(sum((b.f - a.f) * [6, 2, 2, 6][bit_count(a.s) + 1] / 24.0), 9) + 0.0 AS value
    FROM f a, (SELECT CAST(unnest(range(4)) AS INTEGER) AS i) features
    JOIN f b ON b.p_partkey = a.p_partkey AND b.s = a.s | (1 << i) AND a.s & (1 << i) = 0
    GROUP BY a.p_partkey, i"""

SQL = {
    # six scaled numbers, then one slot per language and two for unseen and invalid ones
    "assembled_features": f"WITH {_FACTS} "
    + " UNION ALL ".join(
        f"SELECT doc_id, {i} AS slot, round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS value "
        f"FROM facts"
        for i, c in enumerate(NUMBERS)
    )
    + """ UNION ALL SELECT doc_id, CAST(6 + slot AS INTEGER) AS slot, CASE WHEN slot = ix THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
        FROM facts JOIN levels USING (lang), range((SELECT count(*) + 2 FROM levels)) s(slot)""",
    "fit_logistic": f"""WITH RECURSIVE {_fits(_L1)}
        SELECT doc_id, y AS truth, CAST(score > 0.5 AS INTEGER) AS pred, round(score, 5) AS score FROM scored""",
    "logistic_coefficients": f"""WITH RECURSIVE {_fits(_BOTH)}
        SELECT model, CAST(CASE WHEN k = len(beta) THEN -1 ELSE k - 1 END AS INTEGER) AS slot, round(beta[k], 5) + 0.0 AS value
        FROM (SELECT model, beta, unnest(range(1, len(beta) + 1)) AS k FROM fit WHERE step = 25)""",
    "score_table": f"""WITH RECURSIVE {_fits(_L2.format(held=1), _IN_PARTS)}
        SELECT doc_id, round(score, 5) AS score FROM scored WHERE fold = held""",
    "cv_scores": f"""WITH RECURSIVE {_fits(_L2.format(held="unnest(range(5))"))}
        SELECT held AS fold, round(auc, 6) AS auc FROM aucs WHERE unseen""",
    "univariate_logistic": f"""WITH RECURSIVE {_FACTS},
        cells AS (SELECT doc_id, feature, v FROM facts UNPIVOT (v FOR feature IN ({", ".join(NUMBERS)}))),
        given AS (SELECT feature, v, quality AS y FROM cells JOIN labels USING (doc_id)),
        fit AS (
          SELECT DISTINCT feature, 0 AS step, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b FROM given
          UNION ALL
          SELECT feature, step + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab),
                 b - (haa * gb - hab * ga) / (haa * hbb - hab * hab)
          FROM (
            SELECT feature, step, a, b, sum(p - y) AS ga, sum((p - y) * v) AS gb, sum(p * (1 - p)) AS haa, sum(p * (1 - p) * v) AS hab,
                   sum(p * (1 - p) * v * v) AS hbb
            FROM (SELECT f.*, g.v, g.y, 1 / (1 + exp(-(f.a + f.b * g.v))) AS p FROM fit f JOIN given g USING (feature) WHERE f.step < 25) seen
            GROUP BY feature, step, a, b))
        SELECT feature, round(b, 8) AS slope, round(a, 5) AS intercept FROM fit WHERE step = 25""",
    "tree_attribution": _TREE_ATTRIBUTION,
}
