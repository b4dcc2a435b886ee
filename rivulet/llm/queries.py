"""The registered queries of this package and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from rivulet.llm import license_scan, mixing, warc
from rivulet.llm.bpe import op6_bpe
from rivulet.llm.conversations import op13_conversations
from rivulet.llm.fingerprint import op3_fingerprint
from rivulet.llm.language import op11_language
from rivulet.llm.license_scan import op4_license_scan
from rivulet.llm.mixing import op7_mixing
from rivulet.llm.neighbours import op5_neighbours
from rivulet.llm.quality import op2_quality
from rivulet.llm.runs import op12_runs
from rivulet.llm.similarity_join import op9_similarity_join
from rivulet.llm.token_counts import op8_token_counts
from rivulet.llm.url_filter import op10_url_filter
from rivulet.llm.warc import op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_quality": op2_quality,
    "op3_fingerprint": op3_fingerprint,
    "op4_license_scan": op4_license_scan,
    "op5_neighbours": op5_neighbours,
    "op6_bpe": op6_bpe,
    "op7_mixing": op7_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_similarity_join": op9_similarity_join,
    "op10_url_filter": op10_url_filter,
    "op11_language": op11_language,
    "op12_runs": op12_runs,
    "op13_conversations": op13_conversations,
}

SQL: dict[str, str] = {
    "op1_warc": warc.SQL,
    "op4_license_scan": license_scan.SQL,
    "op7_mixing": mixing.SQL,
}
