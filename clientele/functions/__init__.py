"""clientele.functions"""
