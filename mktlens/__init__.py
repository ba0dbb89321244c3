"""mktlens: customer and marketing attribution operators on Spark DataFrames.

Sub-packages:

* ``functions``  - scalar column expressions (case folding, boundary-count
  date differences, n-th regex match, guarded division, ...).
* ``operators``  - reusable relational operators (interval join, wildcard
  join, null-aware anti join, unpivot of slots, top-k, moving average ...).
* ``sources``    - table readers, sinks and the bindings that derive the
  marketing relations from the driver's tables.
* ``plans``      - the six analytical plans (journey, value, halo, spend,
  organic, paid), each a chain of small DataFrame functions.
"""

__version__ = "0.1.0"
