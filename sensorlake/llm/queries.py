"""The queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from sensorlake.llm.decontamination import ORACLE as DECONTAMINATION_SQL
from sensorlake.llm.decontamination import op4_decontamination
from sensorlake.llm.language import op9_language
from sensorlake.llm.licenses import op5_licenses
from sensorlake.llm.mixing import op8_mixing
from sensorlake.llm.near_duplicates import op7_near_duplicates
from sensorlake.llm.personal import op6_personal_data
from sensorlake.llm.quality import op3_quality_rules
from sensorlake.llm.search import ORACLE as SEARCH_SQL
from sensorlake.llm.search import op13_search
from sensorlake.llm.substrings import ORACLE as SUBSTRINGS_SQL
from sensorlake.llm.substrings import op12_substrings
from sensorlake.llm.toxicity import op1_toxicity
from sensorlake.llm.urls import op2_url_filter
from sensorlake.llm.warc import op10_warc
from sensorlake.llm.whitening import op11_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_url_filter, op3_quality_rules, op4_decontamination, op5_licenses,
        op6_personal_data, op7_near_duplicates, op8_mixing, op9_language, op10_warc, op11_whitening,
        op12_substrings, op13_search,
    )
}
ORACLES = {"op4_decontamination": DECONTAMINATION_SQL, "op12_substrings": SUBSTRINGS_SQL, "op13_search": SEARCH_SQL}
