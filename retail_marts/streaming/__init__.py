"""Streaming: intentionally empty.

The modelled system loads its warehouse in batches and describes no stream,
watermark, window over event time or stateful operator, so nothing here is
built. A continuous load would run the same ``plans.warehouse`` steps from
``foreachBatch``; it is not needed by any operator of the inventory.
"""
