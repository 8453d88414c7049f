"""codeloom: code crosswalks and weighted allocation on Spark DataFrames.

Build concordances between hierarchical classification codes (exact,
longest-prefix, wildcard and fallback matching), grade them by fan-out,
split record weights across one-to-many matches, report coverage, and
apply visit-attribution rules to page and event logs in batch or stream.
Every public operator is ``DataFrame -> DataFrame`` and composes with
``DataFrame.transform``.
"""

__version__ = "0.1.0"
