"""partflow: keyed stateful operators for assembling records that arrive in pieces.

Every operator has a batch form (DataFrame joins, aggregates and windows that
Catalyst plans) and, where the semantics are stateful, a Structured Streaming
form built on ``transformWithState``.

    from partflow import wait_join_full, machine_stream, WaitJoin
"""

__version__ = "0.1.0"

_EXPORTS = {
    # batch closed forms
    "wait_join_full": "partflow.operators.waitjoins",
    "wait_join_left": "partflow.operators.waitjoins",
    "collect_join": "partflow.operators.waitjoins",
    "patch_join": "partflow.operators.waitjoins",
    "apply_patch": "partflow.operators.waitjoins",
    "priced_wait_join": "partflow.operators.waitjoins",
    "latest_value_join": "partflow.operators.latest",
    "last_n": "partflow.operators.latest",
    "first_per_key": "partflow.operators.latest",
    "word_count": "partflow.operators.text",
    "running_word_count": "partflow.operators.text",
    "price_cars": "partflow.operators.pricing",
    "fetch_prices": "partflow.operators.pricing",
    "route": "partflow.operators.routing",
    "route_counts": "partflow.operators.routing",
    "bounded_broadcast": "partflow.operators.sizing",
    # general ordered batch form and streaming
    "run_machine": "partflow.operators.sequential",
    "machine_stream": "partflow.streaming.runner",
    "topic_frame": "partflow.streaming.runner",
    "MachineProcessor": "partflow.streaming.processor",
    "WaitJoin": "partflow.streaming.machines",
    "Assembly": "partflow.streaming.machines",
    "Latest": "partflow.streaming.machines",
    "LastN": "partflow.streaming.machines",
    "First": "partflow.streaming.machines",
    "RunningCount": "partflow.streaming.machines",
    # sources and sinks
    "encode": "partflow.sinks.topics",
    "decode": "partflow.sources.topics",
    "consumer_options": "partflow.sources.topics",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name):
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
