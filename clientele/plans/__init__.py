"""clientele.plans"""
