"""Queries of the training-data operators over the whole given tables, and their SQL."""

from __future__ import annotations

from classbench.llm.html_text import op8_html
from classbench.llm.imatch import op5_imatch
from classbench.llm.mixing import op6_mixing
from classbench.llm.oracle import VARIANTS_SQL, WARC_SQL, pii_sql
from classbench.llm.packing import op2_packing
from classbench.llm.pii import op1_pii
from classbench.llm.quality import op4_quality
from classbench.llm.quality_pu import op12_quality
from classbench.llm.runs import op13_runs
from classbench.llm.simhash import op3_simhash
from classbench.llm.toxicity import op10_toxicity
from classbench.llm.urls import op7_urls
from classbench.llm.variants import op11_variants
from classbench.llm.warc import op9_warc

QUERIES = {f.__name__: f for f in (op1_pii, op2_packing, op3_simhash, op4_quality, op5_imatch, op6_mixing, op7_urls,
                                   op8_html, op9_warc, op10_toxicity, op11_variants, op12_quality, op13_runs)}
#: The others learn, draw or hash in ways SQL has no words for; tests/llm holds them against brute force.
ORACLE = {"op1_pii": pii_sql(), "op9_warc": WARC_SQL, "op11_variants": VARIANTS_SQL}
