"""plume: social-post trend analytics as plain Spark DataFrame operators.

Layers
------
* ``sources``   – topic/file scans, envelope builder, sinks, log tails.
* ``operators`` – bronze → silver → gold transforms, views, text, models, upkeep.
* ``functions`` – Column-level helpers (cleaning, time, engagement, arrays).
* ``streaming`` – run any operator as a Structured Streaming query.
* ``plans``     – the registered query catalog and its SQL oracle.

Every operator is ``DataFrame -> DataFrame`` with no action inside and the
clock passed in, so the same code serves batch, streaming and the oracle.
"""

__version__ = "0.1.0"
