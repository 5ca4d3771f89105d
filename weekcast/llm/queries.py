"""All registered queries of this folder: importing the operators fills the registry."""

import corpus_pipeline

from . import (  # noqa: F401
    decontaminate,
    html_wrappers,
    line_dedup,
    merkle,
    mixing,
    near_dedup,
    period_runs,
    quality_bayes,
    quality_rules,
    secrets,
    sharding,
    token_files,
    toxic_crf,
)
from .registry import ORACLE, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
