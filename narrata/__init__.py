"""narrata: complaint-narrative analytics as Spark DataFrame operators.

Text functions are ``Column -> Column`` (``narrata.functions``); table
operators are ``DataFrame -> DataFrame`` (``narrata.operators``). Every
operator is expressed with built-in Spark SQL expressions so Catalyst can
push filters, prune columns and keep the work inside whole-stage codegen;
Arrow-batched pandas UDFs appear only where no built-in expresses the
semantics (ROUGE-L's LCS, caller-supplied model scoring).
"""

from narrata.session import get_session, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
