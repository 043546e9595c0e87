"""Column-expression builders: spelling normalisation, character and feature
formats, templates. Each returns a ``Column`` made of built-in functions, so it
stays inside whole-stage code generation."""
