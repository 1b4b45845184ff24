"""Column-expression helpers; everything here stays inside whole-stage codegen."""
