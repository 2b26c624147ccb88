"""Column expressions: everything here builds a Column and runs inside whole-stage codegen."""
