"""crashlens: Spark-native crash-record analytics and route-risk scoring.

Sub-packages:
    sources    -- table readers, derived fixture views, payload parsers, sinks
    functions  -- column-expression feature functions (no UDFs except polyline)
    operators  -- relational operators: reads, cleaning, one-hot, radius join,
                  split, metrics, thresholds, resampling, route geometry, roll-up
    plans      -- composed jobs: feature builders, training, route-risk scoring
    streaming  -- Structured Streaming entry point for landed route payloads
"""

__version__ = "0.1.0"
