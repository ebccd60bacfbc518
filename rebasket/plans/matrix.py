"""From shop tables to the feature matrix and the labelled set."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame

from rebasket.functions.keys import PAIR
from rebasket.operators.features import (
    derive_features,
    features_join,
    line_features,
    pair_summary,
    purchases,
    user_features_1,
)
from rebasket.operators.labels import LABEL, candidate_orders, filled, pair_labels, train_lines
from rebasket.plans.retail import Shop
from rebasket.session import stored


def joined_features(s: Shop) -> DataFrame:
    """The four feature tables joined, from one pass over the lines."""
    uf2, up, prd = line_features(_pairs(s))
    return features_join(up, prd, user_features_1(s.orders), uf2)


_kept: dict[str, DataFrame] = {}
_keeping = threading.Lock()


def _pairs(s: Shop) -> DataFrame:
    """One stored row per user and product, which the line features read; once per application, as the shop tables."""
    with _keeping:
        if s.where not in _kept or not s.where:
            _kept[s.where] = stored(pair_summary(stored(purchases(s.order_products_prior), "purchases")), "pairs")
        return _kept[s.where]


def feature_matrix(s: Shop) -> DataFrame:
    """Ids and the 18 model inputs."""
    return derive_features(joined_features(s))


def labelled_matrix(s: Shop) -> DataFrame:
    """The matrix with candidate order and label.

    The candidate order belongs to the user, so it joins the user table before
    the pair rows do: these meet the users once, in a join of its own stage that
    adaptive execution can split at a hot user. The label joins the pair rows before
    the other features widen them, so that shuffle moves a few columns only.
    """
    uf2, up, prd = line_features(_pairs(s))
    users = user_features_1(s.orders).join(candidate_orders(s.orders), "user_id")
    known = up.join(pair_labels(train_lines(s.order_products_train, s.orders)), PAIR, "left")
    rows = filled(derive_features(features_join(known, prd, users, uf2)))
    return rows.select(*PAIR, *[c for c in rows.columns if c not in [*PAIR, LABEL]], LABEL)
