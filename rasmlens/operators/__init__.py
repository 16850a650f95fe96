from rasmlens.operators.arena import (
    ModelArena, Trial, best_trial, default_estimators, feature_importance, fit_trial, ranking)
from rasmlens.operators.clean import (
    add_stylometrics, add_tokens, clean, list_tokens, prepare, prepare_listed)
from rasmlens.operators.density import kernel_density
from rasmlens.operators.evidence import (
    duality_gap, forest_nodes, forest_votes, importance_by_hand, split_gains)
from rasmlens.operators.explore import (
    class_composition, correlation_matrix, distribution_by_class, label_counts, row_count,
    token_counts, top_tokens)
from rasmlens.operators.features import feature_stages, fit_features, vectorize
from rasmlens.operators.metrics import (
    accuracy_and_f1, confusion_counts, confusion_matrix, evaluate_on_test, roc_auc, score)
from rasmlens.operators.percentiles import percentiles_by_class
from rasmlens.operators.ranks import auc_by_model
from rasmlens.operators.reshape import ingest, melt, union_all
from rasmlens.operators.sampling import (
    bernoulli_sample, hash_sample, hash_split, random_split, random_split_two_stage,
    sample_limit, split_index)
from rasmlens.operators.sweep import inference_sweep
from rasmlens.operators.terms import scale_by_deviation, term_counts, term_idf, tfidf
from rasmlens.operators.vocabulary import count_by_vocabulary, tag_vocabulary

__all__ = [
    "ModelArena", "Trial", "accuracy_and_f1", "add_stylometrics", "add_tokens", "auc_by_model",
    "bernoulli_sample", "best_trial", "class_composition", "clean", "confusion_counts",
    "confusion_matrix", "correlation_matrix", "count_by_vocabulary", "default_estimators",
    "distribution_by_class", "duality_gap", "evaluate_on_test", "feature_importance", "feature_stages",
    "fit_features", "fit_trial", "forest_nodes", "forest_votes", "hash_sample", "hash_split",
    "importance_by_hand", "inference_sweep", "ingest", "kernel_density", "label_counts", "list_tokens", "melt",
    "percentiles_by_class", "prepare", "prepare_listed", "random_split", "random_split_two_stage", "ranking", "roc_auc", "row_count",
    "sample_limit", "scale_by_deviation", "score", "split_gains", "split_index", "tag_vocabulary",
    "term_counts", "term_idf", "tfidf", "token_counts", "top_tokens", "union_all", "vectorize",
]
