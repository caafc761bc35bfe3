"""No streaming operator is defined here on purpose.

The data model has no event time and no state across batches. The row-wise operators (exclusion
filters, language detection, line counts, rule scanning, metrics, text and JSON rendering) are plain
column expressions or stream-static joins, so they accept a streaming ``files`` DataFrame unchanged;
``tests/test_streaming.py`` runs some of them on one.
"""
