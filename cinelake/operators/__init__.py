"""DataFrame -> DataFrame operators; see each module for the semantics."""

from cinelake.operators.aggregates import (
    count_distinct,
    count_distinct_tuple,
    fit_line,
    group_count,
    group_count_distinct,
    pearson,
    row_count,
    success_rate,
)
from cinelake.operators.filters import (
    dropna_any,
    filter_isin,
    filter_like_any,
    filter_min,
    filter_nonzero,
    filter_tag_token,
    filter_where,
    replace_sentinel,
    search_like,
)
from cinelake.operators.joins import (
    ids_found,
    ids_missing,
    inner_join,
    left_lookup,
    lookup_key,
)
from cinelake.operators.keys import KeyRegistry
from cinelake.operators.projection import add_literal, drop_columns, project_alias, rename_columns, reorder_columns
from cinelake.operators.quality import (
    Funnel,
    audit,
    describe_profile,
    fk_violations,
    key_consistency,
    null_violations,
    pk_violations,
    schema_diff,
    stage_counts,
)
from cinelake.operators.sets import distinct_rows, distinct_values, drop_duplicates
from cinelake.operators.sketches import SketchTable
from cinelake.operators.sorting import capped, sort_asc, sort_desc, top_k
from cinelake.operators.windows import (
    balanced_split,
    batch_assign,
    number_in_order,
    share_of_total,
    surrogate_key,
    surrogate_key_counted,
    top_n_per_group,
)

__all__ = [name for name in dir() if not name.startswith("_")]
