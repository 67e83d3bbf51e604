"""threadlake — Spark-native search and recall over conversation transcripts.

Every operator is a function from DataFrames to DataFrames; nothing is
collected to the driver except bounded scalars.  Sub-packages:

* ``sources``   – raw JSONL / chat-export readers, incremental upserts, sinks,
                  and the mapping from the driver's test tables to model tables
* ``functions`` – Column-level helpers (tokenizer, text cleanup, vectors, scores)
* ``operators`` – full-text index & search, vectors, graph, sessions, digests,
                  fact extraction
* ``plans``     – composed user-facing plans (search_sessions, thread_recall,
                  find_similar, index_stats) and the full-text query builder
* ``streaming`` – token-pressure monitor (stateless bells + stateful latch)
"""

__version__ = "0.1.0"
