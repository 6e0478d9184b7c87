"""Independent SQL oracles used by the correctness gate and the tests."""
