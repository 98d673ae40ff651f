"""Specifications of inputs and the flow that is composed from them."""
