"""eventmart: an events-and-groups analytics pipeline expressed as Spark jobs.

Layers (each a sub-package):

* ``config``     frozen settings, dataset catalogue, rename maps, declared schemas
* ``sources``    CSV reading, null tokens, type inference, by-name binding,
                 file-level encoding detection
* ``functions``  reusable column expressions
* ``operators``  staging projections, the five marts, keyed upsert, data-quality
                 checks, sampling helpers, measured broadcast and salted skew joins
* ``sinks``      table store, bucket-scoped merge and publication, CSV exports,
                 monitoring logs and their compaction
* ``plans``      the flows (set-up, raw load, batch, mart build) and the layer
                 that maps the benchmark tables onto the domain tables
* ``streaming``  the incremental micro-batch runner (Structured Streaming)
* ``cli``        spark-submit entry for the flows and table maintenance
"""

__version__ = "0.1.0"
