"""tablesift: data profiling on Spark.

Entry points:

* ``tablesift.session.build_session`` - a session with the library defaults.
* ``tablesift.operators.attributes.AttributeSpace`` with the ``TRIMMED`` and
  ``STRICT`` presets, and the plans in ``operators.attributes`` /
  ``operators.ind`` (unary INDs, lines, profile, sets, overlap, candidates,
  check, implied).
* ``tablesift.operators.nary.nary_inds`` - level-wise n-ary INDs.
* ``tablesift.operators.lcs`` - longest shared substring per id, witness pairs.
* ``tablesift.operators.relational`` and ``tablesift.operators.tree``.
* ``tablesift.plans.jobs.discover_folder`` - folder of CSV files to IND lines.
* ``tablesift.plans.catalog`` - the registered queries and their DuckDB SQL.
"""
