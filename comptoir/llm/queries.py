"""All registered queries of this subpackage and the pipeline, for __spark_entry__.py."""

import corpus_pipeline
from comptoir.llm import covertree, fingerprints, importance, jaccard, langid, licenses, lines, lm, mixing, packing, spelling, tokencounts, toxicity  # noqa: F401
from comptoir.llm.common import QUERIES, SQL

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
