"""A PySpark-native engine for layout-extracted technical documents and training text."""

from .operators.graft import best_match, merge
from .operators.render import assemble, full
from .operators.scan import scan
from .operators.toc import apply as repair_headings
from .plans.chain import clean, clean_table, full_report

__all__ = ["assemble", "best_match", "clean", "clean_table", "full", "full_report", "merge", "repair_headings", "scan"]
