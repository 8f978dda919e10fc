"""A caller-supplied word split (here lower-cased whitespace split) flows
through vocabulary, lookup and examples."""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paths import SF_SMALL
from pairloom import Preparation
from pairloom.sources.corpus import documents_corpus, table


@F.pandas_udf(T.ArrayType(T.StringType()))
def lower_split(s: pd.Series) -> pd.Series:
    return s.str.lower().str.split()


def test_pluggable_split(spark):
    p = Preparation(documents_corpus(table(spark, SF_SMALL, "documents")), split_fn=lower_split)
    toks = {r.token for r in p.vocab.collect()}
    assert all(t == t.lower() for t in toks if not t.startswith("["))
    assert p.examples.count() == p.n_examples > 0
