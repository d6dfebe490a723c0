"""DataFrame -> DataFrame operators: decode, ordinals, batch/flush planning, unions, metrics."""
