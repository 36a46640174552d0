"""starloom: build a clean star schema from messy, wide, string-typed sources on Spark.

Every public function takes and returns Spark ``DataFrame`` objects (or ``Column``
expressions); configuration such as paths, id columns and key lists is passed as
parameters.  Nothing here holds a module-level session.
"""

__version__ = "0.1.0"
