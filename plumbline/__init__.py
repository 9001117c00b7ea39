"""Rule-driven data quality on Spark: declare rules as data, judge every row, keep an audit log."""

from plumbline.operators.counts import result_patterns, rule_counts, rule_counts_from_results, run_summary
from plumbline.operators.program import RuleMapping, load_program, pack_program
from plumbline.operators.verdicts import apply_rules, enrich
from plumbline.packs import Pack, PackRule, load_pack, read_pack
from plumbline.plans.onboarding import onboard
from plumbline.plans.runs import entity_reports, run_entity
from plumbline.sources.store import Store

__all__ = [
    "Pack", "PackRule", "RuleMapping", "Store", "apply_rules", "enrich", "entity_reports", "load_pack",
    "load_program", "onboard", "pack_program", "read_pack", "result_patterns", "rule_counts", "rule_counts_from_results",
    "run_entity", "run_summary",
]
