"""Column functions. All are native expressions and safe under ANSI mode."""
