"""The quality stage's plan: its filter must not spell out the elimination."""

import random

from captionlake.llm import quality_rules

from .test_operators import docs, sentence


def test_keep_compiles(spark):
    """Every stage compiles to whole code: no fallback to interpreted expressions, however the filter is placed."""
    rnd = random.Random(71)
    texts = [sentence(rnd, 60) for _ in range(80)] + [None, "", "$$$ " * 40, "a " * 50]
    before = {k: spark.conf.get(k) for k in ("spark.sql.codegen.fallback", "spark.sql.codegen.factoryMode")}
    try:
        spark.conf.set("spark.sql.codegen.fallback", "false")
        spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
        d = docs(spark, texts)
        kept = quality_rules.keep(d)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert len(plan) < 60_000
        ids = {r.doc_id for r in kept.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {r.doc_id for r in quality_rules.quality_rules(d).where("kept").collect()}
    assert ids == want and 40 < len(ids) <= 80
