"""marketlens: marketplace analytics expressed as Spark DataFrame plans.

Layers (each a plain ``DataFrame -> DataFrame`` function):

* ``sources``   - typed scans of the input tables, the marketplace entity
                  adapters, the calendar generator and the sinks.
* ``functions`` - column expressions (money, calendar attributes, guarded
                  ratios) that stay inside whole-stage codegen.
* ``operators`` - reusable relational operators: staging projections,
                  the distributed ordered window, SCD2, keyed inserts and
                  updates, recursive hierarchies, data-quality checks.
* ``plans``     - the business models, reports and analytical questions.
* ``streaming`` - micro-batch drivers for the stateful snapshot operator.
"""

__version__ = "0.1.0"
