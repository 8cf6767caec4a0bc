"""Flat user-facing API: the operators a workflow script calls, under one import.

    from quarry import api as q
    df = q.read_csv(spark, path)                       # null tokens ".", "NA", "", "?"
    df = q.stratified_split(df, "TargetB", "ID", (0.5,))
    prep = q.FittedPrep.fit(df, numeric, nominal, where=F.col("split") == "train")
"""

from quarry.functions.columns import (  # noqa: F401
    below_null, cutoff_class, daypart, hour_of_text, level_map, linear_predictor, null_tokens, ordinal_rank,
    parse_number, sentinel_null, sigmoid, weighted_score)
from quarry.functions.pvalues import chi2_sf, f_sf, t_quantile, t_two_sided  # noqa: F401
from quarry.operators.basket import (  # noqa: F401
    association_rules, basket_summary, build_baskets, item_frequency, size_distribution, top_rules)
from quarry.operators.cluster import elbow, fit_kmeans, multistart, profile, project_2d, total_ss  # noqa: F401
from quarry.operators.evaluate import (  # noqa: F401
    auc, avg_profit, best_cutoff_topleft, confusion_counts, confusion_inference, confusion_stats, lift_at,
    lift_curve, profit_cutoff, roc_points, with_rates)
from quarry.operators.explore import (  # noqa: F401
    arg_extremes, class_shares, contingency, crosstable, exact_quantiles, freq_desc, histogram, level_counts,
    missing_fraction, missing_map, moments, numeric_summary, quantile_table, top_n, trimmed_mean_mad)
from quarry.operators.bagging import (  # noqa: F401
    Forest, gini_importance, oob_error, oob_permutation_importance, out_of_bag, valid_error)
from quarry.operators.bagging import fit as fit_bagged_forest  # noqa: F401
from quarry.operators.bagging import tune_mtry as tune_bagged_mtry  # noqa: F401
from quarry.operators.forest import (  # noqa: F401
    balanced_ensemble, ensemble_probability, error_by_trees, fit_forest, importance_rows, permutation_importance,
    tune_mtry)
from quarry.operators.importance import (  # noqa: F401
    abs_correlation, anova_f, binned_r2, chi2_table, level_codes, single_input_auc, welch_t)
from quarry.operators.impute import apply_fill, fit_means, fit_medians, fit_modes  # noqa: F401
from quarry.operators.logistic import coefficient_table, fit_logit, null_logit, stepwise  # noqa: F401
from quarry.operators.mlp import fit_early_stopping  # noqa: F401
from quarry.operators.network import Network, fit_network  # noqa: F401
from quarry.operators.prep import FittedPrep  # noqa: F401
from quarry.operators.ranking import with_running_totals  # noqa: F401
from quarry.operators.sampling import downsample, inverse_prior_weights, stratified_split  # noqa: F401
from quarry.operators.scoring import ScoringPipeline  # noqa: F401
from quarry.operators.select import (  # noqa: F401
    columns_matching, columns_of_kind, complete_cases, drop_by_position, member_flag, role_profile, row_slice, select_by_position,
    select_by_regex, semi_member, which_rows, with_row_index)
from quarry.operators.transforms import (  # noqa: F401
    add_dummies, add_missing_flags, all_pairs, best_lambda, dummy_levels, log1p_columns, missing_flag_columns,
    power_profile, products, recode, refined_lambda, relevel, reverse_levels, standardize)
from quarry.operators.tree import (  # noqa: F401
    cart_leaf_counts, cart_rules, grow_cart)
from quarry.operators.tree import (  # noqa: F401
    at_cp, choose, cross_validated_path, evaluate_path, grow, leaf_counts, pruning_path, rules)
from quarry.sources.bundle import load_bundle, save_bundle  # noqa: F401
from quarry.sources.csv import infer_types, read_csv, read_csv_text, write_csv  # noqa: F401
from quarry.sources.tables import read_table  # noqa: F401
from quarry.streaming.score_stream import score_stream, table_stream  # noqa: F401
