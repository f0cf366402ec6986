"""Spark jobs that prepare prompts for synthetic labelled text, gate the
completions that come back, and curate and measure the resulting datasets."""

from synthcurate.plans.curate import CurationSpec, curate
from synthcurate.session import build_session, configure

__all__ = ["CurationSpec", "build_session", "configure", "curate"]
