"""evenkeel: bias audits and preparation of training tables on Spark."""

from evenkeel.functions.vectors import vector_parts
from evenkeel.operators.categories import (
    CategoryDictionary, category_dictionary, with_category_index, with_category_vectors,
)
from evenkeel.operators.clean import (
    align_features, assign_roles, binarize, drop_if_present, drop_missing, group_key, infer_roles,
    missing_counts, numeric_features, recode, to_label, to_numeric,
)
from evenkeel.operators.contingency import contingency, recount
from evenkeel.operators.features import (
    FittedPreprocessor, fit_preprocessor, impute_median, one_hot, standardize,
)
from evenkeel.operators.impact import (
    disparate_impact, disparate_impact_report, positive_rate_by_group,
)
from evenkeel.operators.mitigate import group_rates, oversample, oversample_plan
from evenkeel.operators.model import TrainedModel, predict, train_regressor
from evenkeel.operators.observed import observed_copy, quality_counts
from evenkeel.operators.odds import (
    between_group_difference, classification_by_group, classification_overall, equalized_odds,
    equalized_odds_report,
)
from evenkeel.operators.parity import (
    demographic_parity, demographic_parity_report, overall_selection_rate,
    positive_rate_difference, positive_rate_report, selection_rate_by_group, selection_rate_rollup,
)
from evenkeel.operators.quantiles import exact_medians
from evenkeel.operators.reports import group_report
from evenkeel.operators.sampling import (
    Splits, cap_rows, draw_with_replacement, exact_rank, shuffle, split_labels, split_sizes,
    train_val_test_split, with_copy_numbers,
)
from evenkeel.operators.validate import (
    binary_violations, check_binary, check_expected_columns, distinct_preview, encoding_suspects,
    group_cardinality, null_ratio, profile, require_columns, require_nonempty, require_null_ratio,
    target_is_constant, validate, value_shares,
)
from evenkeel.plans import land, mitigation_flow, odds_flow, parity_flow, prepare
from evenkeel.sources import (
    GroupReport, Landing, infer_types, land_csv, malformed_rows, materialize, read_csv, read_parquet, write_report, write_splits,
    write_table,
)
from evenkeel.spec import (
    EUROSTAT, LABOUR_MARKET, TOY, ColumnRoles, DatasetSpec, EmptyInputError, ValidationError,
    parse_features,
)
