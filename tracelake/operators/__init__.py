"""Window and join operators over traces: call frames, gas, memory, cold access, created addresses."""
