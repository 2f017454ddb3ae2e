"""Headline benchmark: one JSON line with seconds per query.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.  ``$BENCH_QUERIES`` (comma separated prefixes, or ``all``) picks others.
"""

from __future__ import annotations

import json
import os
import re
import time

HEADLINE = (
    "s4_repeated_rows", "s5_sectioned_rows", "s10_entity_docs", "s14_unseen_scan", "p10_readability",
    "j5_certain_link", "j6_cascade", "j16_max_overlap", "j17_containment", "j18_span_interval", "j19_null_safe_first",
    "j20_reconcile", "j24_two_evidence",
    "a2_metric_denominators", "a3_segments_residual", "a7_person_sessions", "a11_drop_repeated", "a12_keep_first",
    "a16_upper_median", "a20_speaker_profile",
    "w5_attribution", "w7_longest_block", "w11_first_verbatim", "w13_continuation_merge", "w16_gap_clusters", "w17_nearest_within",
    "o1_newest_nulls_last", "o2_newest_n_hidden", "u3_symmetric_difference",
    "f16_unique_segmentation", "f17_one_edit_repair", "f22_merged_label",
    "t2_bigram_idf", "t3_lexical_support", "t4_citation_locator", "t6_misplaced_claims", "t8_banned_terms", "t11_answer_parser",
    "m1_change_aware_upsert", "m4_scope_replace", "m13_curated_edits", "m17_fan_out",
    "q1_row_constraints", "q3_detail_vs_total", "q14_publish_invariants",
    "st1_fact_merge", "st3_gap_sessions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from attesta.plans import queries
    from attesta.session import local_session

    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    plans, chosen = queries(), os.environ.get("BENCH_QUERIES", "")
    if chosen == "all":
        names = list(plans)
    elif chosen:
        names = [n for n in plans if n.startswith(tuple(chosen.split(",")))]
    else:
        names = [n for n in HEADLINE if n in plans]
    plans["a1_status_rates"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up, not timed
    seconds = {}
    for name in names:
        began = time.perf_counter()
        plans[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
